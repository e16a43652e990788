"""Readers for delimited extracts, resource documents and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.sources.delimited import broken_records, has_quotes
from clinlake.sources.schemas import CORRUPT_COLUMN, DOCUMENT_COLUMN


_QUOTES = {"quote": '"', "escape": '"'}


def read_delimited(spark: SparkSession, path: str | list[str], delimiter: str = "|", multi_line: bool = False) -> DataFrame:
    """A folder of delimited files, or a list of files, with a header; every column is text.

    Large files are split, also those with line breaks inside quotes: a first pass over files with quotes finds such
    breaks, and only where there are any the records are put together from lines (see ``broken_records``). A quote that is
    never closed is an error. With ``multi_line`` Spark reads each file by one task instead, which a ``delimiter`` of
    several characters needs.
    """
    return _delimited(spark, path, delimiter, multi_line)


def read_delimited_typed(
    spark: SparkSession, path: str | list[str], schema: str | None = None, delimiter: str = ",", multi_line: bool = False
) -> DataFrame:
    """``read_delimited`` with types: a declared schema, or inferred ones at the cost of a further read.

    Types are inferred by one task a file where a field holds a line break.
    """
    return _delimited(spark, path, delimiter, multi_line, schema, typed=True)


def read_csv_plain(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Comma-separated files with a header and doubled quotes; every column is text."""
    return _delimited(spark, path, ",", multi_line)


def _delimited(
    spark: SparkSession, path: str | list[str], delimiter: str, multi_line: bool, schema: str | None = None, typed: bool = False
) -> DataFrame:
    options = _QUOTES | {"sep": delimiter}
    reader = spark.read.options(**options, header=True, inferSchema=typed and not schema)
    if schema:
        reader = reader.schema(schema)
    records = None if multi_line or not has_quotes(spark, path) else broken_records(spark, path, delimiter)
    if records is None:
        return reader.option("multiLine", multi_line).csv(path)
    fields = reader.option("multiLine", True).csv(path).schema
    each = F.from_csv("record", fields.toDDL(), options | {"multiLine": "true"})
    # Fields taken from the struct in a projection would each parse the record again.
    return records.select(F.inline(F.array(each)))


def read_json_documents(spark: SparkSession, path: str | list[str], schema: str, multi_line: bool = True) -> DataFrame:
    """One JSON document or array of documents per file, or per line without ``multi_line``; also in sub-folders.

    Each document is kept whole, as a variant in ``_document``, beside the typed columns of ``schema``, which
    are NULL where the document has nothing of the kind. Text that is no JSON stays in ``_corrupt_record``.
    """
    read = (
        spark.read.schema(f"{DOCUMENT_COLUMN} variant, {CORRUPT_COLUMN} string")
        .option("singleVariantColumn", DOCUMENT_COLUMN)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    documents = F.expr(f"coalesce(try_variant_get({DOCUMENT_COLUMN}, '$', 'array<variant>'), array({DOCUMENT_COLUMN}))")
    each = read.select(F.explode(documents).alias(DOCUMENT_COLUMN), CORRUPT_COLUMN)
    typed = each.select(F.from_json(F.to_json(DOCUMENT_COLUMN), schema).alias("_typed"), DOCUMENT_COLUMN, CORRUPT_COLUMN)
    return typed.select("_typed.*", DOCUMENT_COLUMN, CORRUPT_COLUMN)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def read_from_databases(spark: SparkSession, databases: Sequence[str], table: str) -> DataFrame:
    """The same table of several databases stacked by column name; a column one lacks is NULL there."""
    frames = [read_table(spark, database, table) for database in databases]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def snapshot_date(file_name: Column, table: str) -> Column:
    """The date in ``<TABLE>_<yyyymmdd>...``; NULL when the name has none."""
    digits = F.regexp_extract(file_name, rf"{table.upper()}_(\d{{8}})", 1)
    return F.try_to_date(digits, "yyyyMMdd")


def with_snapshot_date(df: DataFrame, table: str, name: str = "timecolumn") -> DataFrame:
    """Add the snapshot date of the file each row was read from; ``df`` must be a file scan."""
    return df.withColumn(name, snapshot_date(F.col("_metadata.file_name"), table))
