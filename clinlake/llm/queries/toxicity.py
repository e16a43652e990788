"""Toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import toxicity


def _fold():
    return F.crc32(F.col("doc_id").cast("string")) % 5


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    """A model of the labelled rows outside the held-out fold."""
    return toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(_fold() != 0))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    score = toxicity.scored(F.col("text"), fitted(spark, docs, sf_dir))
    found = docs.select("doc_id", (_fold() == 0).alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = (op4_toxicity,)
ORACLES: dict[str, str] = {}
