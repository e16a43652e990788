"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps, each a grouped minimum joined back to the edges, until the
edges no longer change. Then every node is joined to the smallest of its component. Each round is
written to the shared working folder, so that no plan grows and no executor holds the only copy. A node with
very many neighbours is the many side of a join with one row per node, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.session import stored


def smallest_in_component(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long -> (node, smallest) for each node of an edge with two ends but the smallest ones.

    Repeated edges, loops and rows with a null end change nothing.
    """
    current = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        before, seen = seen, _digest(current)
        if seen == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("smallest"))
        current = stored(_small_star(_large_star(current)), "edges")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("_low"))
    linked = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.least("a", "_low").alias("b"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("_low"))
    linked = edges.join(lowest, "a").select("b", "_low").filter("b != _low").select(F.col("b").alias("a"), F.col("_low").alias("b"))
    return linked.unionByName(lowest.select("a", F.col("_low").alias("b"))).distinct()
