"""Row-level operators: numbering, rendering, counting, summing and first-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from clinlake.functions.variant import quoted
from clinlake.session import working_folder

# monotonically_increasing_id holds the partition above this bit and the row's place in it below.
_PLACE_BITS = 33


def with_row_number(df: DataFrame, order_by: Sequence[str] | None = None, name: str = "_row_number") -> DataFrame:
    """Number the rows 1, 2, ... in the order of ``order_by``, or in scan order without it.

    No task sees more than its own partition. Rows are written once, in order, to the shared working
    folder with their place in their partition; one count per partition then gives each partition's
    offset. The written table keeps numbers stable when executors are lost. Rows with equal keys are
    ordered by their content and then by scan order, so a key or a row that is repeated very often
    still spreads over several partitions.
    """
    spark = df.sparkSession
    placed = df
    if order_by:
        hashable = [f.name for f in df.schema if not _holds_map_or_variant(f.dataType.simpleString())]
        placed = df.withColumn("_scan", F.monotonically_increasing_id()).withColumn(
            "_content", F.xxhash64(*[F.col(quoted(c)) for c in hashable])
        )
        order = [F.col(quoted(c)) for c in order_by] + [F.col("_content"), F.col("_scan")]
        placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_content", "_scan")
    path = working_folder(spark, "numbered")
    placed.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)

    stored = spark.read.parquet(path)
    partition = F.shiftright("_place", _PLACE_BITS)
    counts = stored.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("rows"))
    # One row per task of the write, so a single sorted window and a broadcast are bounded by that.
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_partition", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        stored.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select(*[F.col(quoted(c)) for c in df.columns], (F.col("_offset") + place + 1).alias(name))
    )


def _holds_map_or_variant(type_name: str) -> bool:
    return "map<" in type_name or "variant" in type_name


def render_rows(df: DataFrame, number: str = "_row_number", name: str = "text") -> DataFrame:
    """One text document per row: a line ``column: value`` for every column; NULL prints as ``None``."""
    lines = [
        F.concat(F.lit(f"{c}: "), F.coalesce(F.col(quoted(c)).cast("string"), F.lit("None"))) for c in df.columns
    ]
    return df.select(F.col(quoted(number)), F.concat_ws("\n", *lines).alias(name))


def sum_as_integer(df: DataFrame, column: str, name: str) -> DataFrame:
    """Global sum of a text column read as integers of up to 38 digits, as decimal(38,0).

    Text that is no integer counts as NULL.
    """
    text = F.trim(F.col(quoted(column)).cast("string"))
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), text).try_cast("decimal(38,0)")
    return df.agg(F.sum(whole).cast("decimal(38,0)").alias(name))


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with a row count that is filled by whatever action uses it, without a job of its own."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias(name)), observation


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    The filter on the row number lets Spark keep one row per key in every task before the shuffle, so a
    key with very many rows does not move or gather them.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
