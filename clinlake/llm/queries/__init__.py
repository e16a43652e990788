"""The queries of this subpackage and their oracle SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinlake.llm.queries import bpe, chat, curves, packing, pii, quality, secrets, simhash, token_counts, toxicity, vector_codes, warc, whitening

_MODULES = (chat, warc, packing, toxicity, curves, simhash, quality, secrets, bpe, pii, token_counts, whitening, vector_codes)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for m in _MODULES for q in m.QUERIES}
ORACLES: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
