"""A training corpus from raw documents: each stage keeps or changes documents, the last one packs them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import packing, quality, secrets, simhash, toxicity
from clinlake.llm.queries.bpe import VOCABULARY
from clinlake.llm.queries.toxicity import fitted
from clinlake.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines their host repeats too often."""
    return quality.kept_documents(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model fitted on the labelled ones among them."""
    score = toxicity.scored(F.col("text"), fitted(spark, docs.select("doc_id", "text"), sf_dir))
    return docs.filter(score < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (3-word shingles) link at 2 or fewer differing bits."""
    return simhash.one_per_component(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by the kind of secret."""
    redacted = F.coalesce(F.col("_found.redacted"), F.col("_doc.text"))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), secrets.scanned(F.col("text")).alias("_found"))
    changed = {"text": redacted, "n_chars": F.length(redacted).cast("long")}
    return found.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids and their place in sequences."""
    return packing.place(packing.pieces(docs, VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("packing", packed_sequences),
]

#: SQL cannot express the scores, fingerprints and ids; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
