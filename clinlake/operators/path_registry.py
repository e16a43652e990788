"""A registry of the document shapes and paths that the batches of a table have had.

Two catalog tables belong to a registry: ``<name>_shapes``, the shapes met so far, and ``<name>_paths``, the sources of wide
columns with the number of the batch that first had them. A batch is looked through for its distinct shapes, and only those
not in the registry are parsed and walked. Sources are never taken out again, so columns keep their names and order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.functions import variant as V
from clinlake.operators import json_columns as J
from clinlake.session import stored, working_scope
from clinlake.sources.writers import append_or_create

_PATH_KEY = ["column", "location", "kind", "name"]


def unseen_shapes(df: DataFrame, json_cols: Sequence[str], database: str, name: str) -> DataFrame:
    """The shapes (column, shape, more) of a batch that the registry does not have."""
    shapes = J.document_shapes(df, json_cols)
    full = f"{database}.{name}_shapes"
    if not df.sparkSession.catalog.tableExists(full):
        return shapes
    return shapes.join(df.sparkSession.table(full).select("column", "shape"), ["column", "shape"], "left_anti")


def register(df: DataFrame, json_cols: Sequence[str], database: str, name: str, nested: Sequence[str] = ()) -> list[J.Source]:
    """Enter what a batch has in the registry; gives all its sources, those of earlier batches first.

    Shapes that cannot stand for their documents, and columns with nested key=value text, are not entered and are looked
    at in every batch. A run that fails has at most entered paths, which the next one finds there.
    """
    spark = df.sparkSession
    present = [c for c in json_cols if c in df.columns]
    flat = [c for c in present if c not in nested]
    paths, shapes = f"{name}_paths", f"{name}_shapes"
    with working_scope(spark):
        unseen = stored(unseen_shapes(df, flat, database, name), "unseen") if flat else None
        found = J.leaves_of(df, present, nested, unseen).select(*_PATH_KEY, "path")
        number = 0
        if spark.catalog.tableExists(f"{database}.{paths}"):
            known = spark.table(f"{database}.{paths}")
            number = (known.agg(F.max("batch")).first()[0] or 0) + 1
            same = F.expr(" and ".join(f"n.{c} <=> k.{c}" for c in _PATH_KEY))
            found = found.alias("n").join(known.alias("k"), same, "left_anti")
        # Stored before it is appended to the table that it was compared with.
        new = stored(found.withColumn("batch", F.lit(number)), "new-paths")
        append_or_create(new, database, paths)
        if unseen is not None:
            settled = unseen.withColumn("_document", V.parse_json_strict("shape")).filter("_document is not null or not more")
            append_or_create(settled.select("column", "shape").withColumn("batch", F.lit(number)), database, shapes)
    return registered(df, json_cols, database, name)


def registered(df: DataFrame, json_cols: Sequence[str], database: str, name: str) -> list[J.Source]:
    """All sources of a registry, by batch, JSON column, path and place."""
    rows = df.sparkSession.table(f"{database}.{name}_paths").filter(F.col("column").isin(list(json_cols)))
    return J.sorted_sources(rows, [c for c in json_cols if c in df.columns])
