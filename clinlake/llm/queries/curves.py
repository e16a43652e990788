"""Nearest neighbours in all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import curves


def op5_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector, among all."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return curves.nearest(vectors, F.col("vec_id") % 100 == 0)


QUERIES = (op5_hilbert_neighbours,)
ORACLES: dict[str, str] = {}
