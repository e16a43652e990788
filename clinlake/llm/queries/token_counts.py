"""Token counts of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clinlake.llm import token_counts


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens exceed the limit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = (op11_token_counts,)
ORACLES: dict[str, str] = {}
