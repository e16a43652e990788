"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
WAREHOUSE_KEY = "spark.sql.warehouse.dir"
CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 8
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"
INFER_SHREDDING = "spark.sql.variant.inferShreddingSchema"
PARQUET_CODEC = "spark.sql.parquet.compression.codec"

_OWNED: ContextVar[list[str] | None] = ContextVar("clinlake_owned_folders", default=None)


def keep_last_duplicate_key(spark: SparkSession) -> None:
    """Let JSON objects repeat a key (the last one wins) instead of losing the document.

    Every operator that parses JSON calls this while it builds its plan, so it changes the caller's session.
    """
    spark.conf.set(DUPLICATE_KEYS, "true")


def split_large_methods(spark: SparkSession) -> None:
    """Let Spark split generated methods that are too long for the JVM to compile, unless the limit is lower already.

    Operators with many expressions a row call this while they build their plan, so it changes the caller's session: their
    rows would be interpreted otherwise. Results do not depend on it.
    """
    if int(spark.conf.get(METHOD_LIMIT)) > COMPILED_BYTES:
        spark.conf.set(METHOD_LIMIT, str(COMPILED_BYTES))


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new path for intermediate tables, in a folder that all executors share.

    That is the one named in ``spark.checkpoint.dir`` or, where it is unset, ``clinlake-work`` in the
    warehouse. Inside ``working_scope`` the path is deleted when the scope ends.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        base = f"{spark.conf.get(WAREHOUSE_KEY).rstrip('/')}/clinlake-work"
    path = f"{base.rstrip('/')}/clinlake/{purpose}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def stored(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """The same rows, written once to a working folder and read from there, so that no later job computes them again."""
    path = working_folder(df.sparkSession, purpose)
    with few_folders(df.sparkSession):
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def few_folders(spark: SparkSession) -> Iterator[None]:
    """Lets tasks that write to a few folders at once keep a file open in each, rather than sort their rows by folder.

    A task that meets more than ``OPEN_FILES`` folders sorts the rest of its rows.
    """
    before = spark.conf.get(CONCURRENT_WRITERS)
    spark.conf.set(CONCURRENT_WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(CONCURRENT_WRITERS, before)


@contextmanager
def whole_variants(spark: SparkSession) -> Iterator[None]:
    """Lets writers store a variant as the one value it is, rather than as a column for each field that its first rows have.

    For documents that are kept whole beside the columns that are read of them, which then need not be taken apart.
    Parquet files are written with zstd, as whole documents repeat much of each other.
    """
    wanted = {INFER_SHREDDING: "false", PARQUET_CODEC: "zstd"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def working_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes every working folder made inside it. Nothing that reads them may be used afterwards."""
    owned: list[str] = []
    token = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in owned:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
