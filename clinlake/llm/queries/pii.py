"""Personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import pii
from clinlake.llm.queries import spans


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = docs.select("doc_id", pii.found_spans(F.col("text"), pii.fit(docs)).alias("_s"))
    return found.select("doc_id", *spans.report(F.col("_s"), pii.KINDS, lambda s: s["is_base"]))


QUERIES = (op10_personal_data,)
ORACLES: dict[str, str] = {}
