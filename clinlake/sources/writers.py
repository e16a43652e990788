"""Writers for catalog tables and files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions.variant import literal, quoted
from clinlake.operators.rows import render_rows
from clinlake.session import delete_folder, few_folders


def has_v2_catalog(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.conf.get("spark.sql.defaultCatalog", "spark_catalog")
    return spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


# Lines of a compressed file.
LINES_PER_FILE = 100_000

#: Table property: where the version before the present one lies.
PREVIOUS = "clinlake.previous.location"


def replace_table(df: DataFrame, database: str, name: str, provider: str | None = None) -> None:
    """Create the table or replace it whole; a replacement that fails leaves the table as it was.

    With a v2 catalog the replacement is atomic and the table's format is ``provider`` (Iceberg,
    format version 2, when none is given). The built-in catalog cannot replace from a query. There the new version is
    written to a folder of its own and the table then set to that location; the version before stays until the next
    replacement. A table whose columns or format change is written under another name, which then takes its place: the
    name is free for a moment between two steps of the catalog, but no version is lost.
    """
    spark, full = df.sparkSession, f"{database}.{name}"
    if has_v2_catalog(spark, full):
        writer = df.writeTo(full).using(provider or "iceberg")
        if (provider or "iceberg") == "iceberg":
            writer = writer.tableProperty("format-version", "2")
        writer.createOrReplace()
        return
    format_name = (provider or "parquet").lower()
    if not spark.catalog.tableExists(full):
        df.write.format(format_name).saveAsTable(full)
    elif _can_move(df, full, format_name):
        _move(df, full, format_name)
    else:
        _swap(df, database, name, format_name)


def _described(spark: SparkSession, full: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _can_move(df: DataFrame, full: str, format_name: str) -> bool:
    spark = df.sparkSession
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(full))
    same_format = _described(spark, full).get("Provider", "").lower() == format_name
    return same_format and not partitioned and _shape(df.schema) == _shape(spark.table(full).schema)


def _move(df: DataFrame, full: str, format_name: str) -> None:
    spark = df.sparkSession
    present = _described(spark, full)["Location"]
    base, _, old = present.rstrip("/").rpartition("/")
    target = f"{base}/{old.split('__version_')[0]}__version_{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(format_name).save(target)
    except Exception:
        delete_folder(spark, target)
        raise
    before = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}.get(PREVIOUS)
    spark.sql(f"ALTER TABLE {full} SET LOCATION {literal(target)}")
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({literal(PREVIOUS)} = {literal(present)})")
    spark.catalog.refreshTable(full)
    if before:
        delete_folder(spark, before)


def _swap(df: DataFrame, database: str, name: str, format_name: str) -> None:
    spark = df.sparkSession
    other = f"{name}__{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(format_name).saveAsTable(f"{database}.{other}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{other}")
        raise
    spark.sql(f"DROP TABLE {database}.{name}")
    spark.sql(f"ALTER TABLE {database}.{other} RENAME TO {database}.{name}")


# Each type and the wider ones that hold all of its values exactly.
_WIDER: dict[type[T.DataType], tuple[type[T.DataType], ...]] = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def keeps_all(given: T.DataType, kept: T.DataType) -> bool:
    """Whether a column of one type can be cast to another without losing any value."""
    if given == kept or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.StructType) and isinstance(kept, T.StructType):
        return [f.name for f in given] == [f.name for f in kept] and all(
            keeps_all(a.dataType, b.dataType) for a, b in zip(given, kept, strict=True)
        )
    if isinstance(given, T.ArrayType) and isinstance(kept, T.ArrayType):
        return keeps_all(given.elementType, kept.elementType)
    if isinstance(given, T.MapType) and isinstance(kept, T.MapType):
        return keeps_all(given.keyType, kept.keyType) and keeps_all(given.valueType, kept.valueType)
    if isinstance(kept, T.DecimalType):
        if isinstance(given, T.DecimalType):
            return kept.scale >= given.scale and kept.precision - kept.scale >= given.precision - given.scale
        return kept.precision - kept.scale >= _DIGITS.get(type(given), 99)
    if isinstance(kept, T.StringType):
        return isinstance(given, (T.StringType, T.IntegralType, T.BooleanType, T.DecimalType, T.DateType))
    return type(kept) in _WIDER.get(type(given), ())


def append_or_create(df: DataFrame, database: str, name: str) -> None:
    """Append to the table if it exists, else create it.

    Columns are matched by name, without case: one the frame lacks is NULL, and one the table lacks is
    added to it. A column is cast to the table's type only where that loses nothing (see ``keeps_all``);
    otherwise ``TypeError`` names the columns, and neither the table's columns nor its rows change.
    """
    spark = df.sparkSession
    full = f"{database}.{name}"
    if not spark.catalog.tableExists(full):
        replace_table(df, database, name)
        return
    aligned = aligned_to(df, full)
    if has_v2_catalog(spark, full):
        aligned.writeTo(full).append()
    else:
        aligned.write.insertInto(full)


def aligned_to(df: DataFrame, full: str, alter: bool = True) -> DataFrame:
    """The frame with the columns of the table, in its order; the table first gets the columns that it lacks.

    Casts are checked before that. Without ``alter`` they are only checked, and the table stays as it is.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(full):
        return df
    given = {f.name.lower(): f for f in df.schema}
    schema = spark.table(full).schema
    lossy = [
        f"{given[f.name.lower()].name} {given[f.name.lower()].dataType.simpleString()} into {f.dataType.simpleString()}"
        for f in schema
        if f.name.lower() in given and not keeps_all(given[f.name.lower()].dataType, f.dataType)
    ]
    if lossy:
        raise TypeError(f"{full} cannot hold {', '.join(lossy)} without loss")
    if not alter:
        return df
    known = {f.name.lower() for f in schema}
    added = [f for f in df.schema if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({columns})")
    return df.select(*[
        (F.col(quoted(given[f.name.lower()].name)) if f.name.lower() in given else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in spark.table(full).schema
    ])


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """CSV files with a header, one per task. Text comes back as it was through ``read_delimited``."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", delimiter)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_row_text(df: DataFrame, path: str, number: str = "_row_number") -> None:
    """Rendered rows as a (row number, text) table: many documents per file, not a file per row."""
    render_rows(df, number).write.mode("overwrite").parquet(path)


def write_annotations_json(responses: DataFrame, path: str) -> None:
    """Raw responses as gzipped JSON lines, in one folder per api; a file is read by one task, so its rows are bounded."""
    with few_folders(responses.sparkSession):
        writer = responses.write.mode("overwrite").partitionBy("api").option("maxRecordsPerFile", LINES_PER_FILE)
        writer.json(path, compression="gzip")


def copy_layer(spark: SparkSession, source_db: str, target_db: str, tables: Sequence[str]) -> None:
    """Copy tables from one database to another, replacing them there."""
    if source_db == target_db:
        raise ValueError("source and target database must differ: a table cannot be replaced while it is read")
    for table in tables:
        replace_table(spark.table(f"{source_db}.{table}"), target_db, table)


def create_table(spark: SparkSession, name: str, columns: str, provider: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` with a column list."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}")


def insert_values(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """Insert literal rows, in the table's column order."""
    spark.createDataFrame(list(rows), spark.table(name).schema).write.insertInto(name)


def insert_select(spark: SparkSession, name: str, view: str, column: str, values: Sequence[str]) -> None:
    """Insert the rows of a view whose ``column`` is one of ``values``."""
    marks = ", ".join(f":v{i}" for i in range(len(values)))
    spark.sql(
        f"INSERT INTO {name} SELECT * FROM {view} WHERE {quoted(column)} IN ({marks})",
        args={f"v{i}": value for i, value in enumerate(values)},
    )


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
