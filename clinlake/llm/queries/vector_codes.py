"""Codes of all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinlake.llm import vector_codes


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, its error, and that of all vectors of its label."""
    return vector_codes.coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


QUERIES = (op13_vector_codes,)
ORACLES: dict[str, str] = {}
