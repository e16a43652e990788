"""BPE encoding and decoding of all documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = bpe.encoded(F.coalesce("text", F.lit("")), VOCABULARY)
    return docs.select("doc_id", _digests(ids, VOCABULARY).alias("_d")).select("doc_id", "_d.*")


def _digests(ids, path: str):
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of_ids(lists: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = bpe.encoder(path)
        for series in lists:
            found = [
                (len(i), _sha256(",".join(map(str, i))), _sha256(own.decode(i))) for i in map(lambda ids: ids.tolist(), series)
            ]
            yield pd.DataFrame(found, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return of_ids(ids)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


QUERIES = (op9_bpe_round_trip,)
ORACLES: dict[str, str] = {}
