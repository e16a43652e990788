"""Whitened embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinlake.llm import whitening


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on up to sixteen whitened components."""
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = (op12_embedding_whitening,)
ORACLES: dict[str, str] = {}
