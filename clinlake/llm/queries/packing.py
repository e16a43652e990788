"""Packing of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import packing
from clinlake.llm.queries.bpe import VOCABULARY


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = packing.pieces(docs, VOCABULARY).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.place(cut)


QUERIES = (op3_best_fit_packing,)
ORACLES: dict[str, str] = {}
