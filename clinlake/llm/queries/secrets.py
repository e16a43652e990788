"""Secrets in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import secrets
from clinlake.llm.queries import spans


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = docs.select("doc_id", secrets.scanned(F.col("text")).alias("_s"))
    kinds = list(secrets.BASE_RULES)
    return found.select("doc_id", *spans.report(F.col("_s.spans"), kinds, lambda s: s["kind"].isin(kinds)))


QUERIES = (op8_secret_scan,)
ORACLES: dict[str, str] = {}
