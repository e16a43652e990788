"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions and put in the order of a Hilbert curve, once for each of ``CURVES``
random projections and shifts. Spark range-partitions and sorts each order. A query looks at the vectors whose rank on
a curve is within a reach of its own; blocks of ranks that the reach touches are joined to the query, its nearest in
each are ranked by exact distance, and the findings of all blocks and curves are merged.

The reach is a share of the table, ``REACH_SHARE`` on either side, which keeps recall when the table grows;
for a fixed share of rows as queries the distances computed therefore grow with the square of the table, like those of
any search of vectors without structure.

Equal vectors are one vector with several ids, of which a search can need only the ``k + 1`` smallest; so a vector
that very many rows hold is searched once and compared once.

Defined results: a vector that is null, zero, or holds a null or non-finite component takes no part, nor does one
whose length is not the table's most frequent (of several, the greatest); rows that repeat an id with one vector
count once, with different vectors each; ties go to the smaller id; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from clinlake.session import stored

CURVES = 8
DIMENSIONS = 8
BITS = 7
REACH_SHARE = 0.08
BLOCK_ROWS, CHUNK_QUERIES = 512, 128
_SEED = 17


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below 2 ** bits; rows times bits fit 63 bits.

    The axes are turned into the transposed index by undoing, from the highest bit down, the exchange and inversion
    that each level of the curve makes, and by a Gray code over all of them.
    """
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i, axis in enumerate(axes):
            high = (axis & level) > 0
            swap = np.where(high, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(high, below, swap)
            if i:
                axes[i] ^= swap
        level >>= 1
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    flip, level = np.zeros(len(cells), dtype=np.int64), 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((axes[-1] & level) > 0, level - 1, 0)
        level >>= 1
    keys = np.zeros(len(cells), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << 1 | ((axis ^ flip) >> bit & 1)
    return keys


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = vectors.schema["embedding"].dataType.elementType
    # Floats stay floats, as they are half as large; anything else is compared as doubles.
    kind = "array<float>" if isinstance(given, FloatType) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding")).filter(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("embedding").alias("_n")).count().orderBy(F.desc("count"), F.desc("_n")).limit(1).collect()
    return rows.filter(F.size("embedding") == (lengths[0]["_n"] if lengths else 0))


def _same(rows: DataFrame) -> tuple[Column, Column]:
    # Adding zero makes one zero of both.
    zero = F.lit(0).cast(rows.schema["embedding"].dataType.elementType)
    positive = F.transform("embedding", lambda x: x + zero)
    return F.xxhash64(positive).alias("_hash"), positive.alias("embedding")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of the k nearest found of each row that is_query names."""
    rows = usable(vectors)
    rows = rows.select("vec_id", *_same(rows)).distinct()
    by_vector = Window.partitionBy("_hash", "embedding").orderBy("vec_id")
    first_ids = rows.withColumn("_n", F.row_number().over(by_vector)).filter(F.col("_n") <= k + 1)
    distinct = stored(
        first_ids.groupBy("_hash", "embedding").agg(F.min("vec_id").alias("_key"), F.sort_array(F.collect_list("vec_id")).alias("_ids")),
        "vectors",
    )
    asked = rows.filter(is_query).withColumnRenamed("vec_id", "query_id")
    asked = stored(asked.join(distinct, ["_hash", "embedding"]).select("query_id", "_key"), "queries")
    found = candidates(distinct.select("_key", "embedding"), asked.select("_key").distinct(), k)
    named = found.join(distinct.select("_key", "_ids"), "_key").select("_query", "score", F.explode("_ids").alias("vec_id"))
    each = asked.select("query_id", F.col("_key").alias("_query")).join(named, "_query").filter("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def candidates(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """_query, _key and score of the k + 1 nearest points (_key, embedding) found of each query (_key, one of them)."""
    n = points.count()
    keep = k + 1
    reach = max(keep, math.ceil(REACH_SHARE * n))
    last_block = max(n - 1, 0) // BLOCK_ROWS
    placed = stored(_ranked(points), "curves")
    blocks = placed.groupBy("_curve", F.floor(F.col("_rank") / BLOCK_ROWS).alias("_block")).agg(
        F.collect_list("_key").alias("_keys"), F.flatten(F.collect_list("embedding")).alias("_points")
    )
    touched = F.sequence(
        F.greatest(F.floor((F.col("_rank") - reach) / BLOCK_ROWS), F.lit(0).cast("long")),
        F.least(F.floor((F.col("_rank") + reach) / BLOCK_ROWS), F.lit(last_block).cast("long")),
    )
    n_chunks = max(1, math.ceil(queries.count() * min(1.0, 2 * REACH_SHARE + BLOCK_ROWS / max(n, 1)) / (CHUNK_QUERIES / 2)))
    looking = placed.join(queries, "_key").select(
        "_curve", F.explode(touched).alias("_block"), F.pmod(F.xxhash64("_key"), F.lit(n_chunks)).alias("_chunk"), "_key", "embedding"
    )
    chunks = looking.groupBy("_curve", "_block", "_chunk").agg(
        F.collect_list("_key").alias("_queries"), F.flatten(F.collect_list("embedding")).alias("_vectors")
    )

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                own = {name: batch[name][at].values.to_numpy(zero_copy_only=False) for name in ("_keys", "_points", "_queries", "_vectors")}
                found = _nearest_in_block(own["_queries"], own["_vectors"], own["_keys"], own["_points"], keep)
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["_query", "_key", "score"])

    met = chunks.join(blocks, ["_curve", "_block"]).select("_keys", "_points", "_queries", "_vectors")
    merged = met.mapInArrow(rank, "_query long, _key long, score double").groupBy("_query", "_key").agg(F.min("score").alias("score"))
    best = Window.partitionBy("_query").orderBy("score", "_key")
    return merged.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= keep).drop("_n")


def _nearest_in_block(queries: np.ndarray, vectors: np.ndarray, keys: np.ndarray, points: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Query, key and exact distance of the nearest of a block; a quick distance leaves out only what is surely farther."""
    a = vectors.astype(np.float64).reshape(len(queries), -1)
    b = points.astype(np.float64).reshape(len(keys), -1)
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    quick = squares - 2 * (a @ b.T)
    which, place = np.divmod(np.arange(quick.size), len(keys))
    if len(keys) > keep:
        limit = np.partition(quick, keep - 1, axis=1)[:, keep - 1]
        near = np.flatnonzero((quick <= limit[:, None] + 1e-9 * (squares + 1)).ravel())
        which, place = which[near], place[near]
    score = np.sqrt(((a[which] - b[place]) ** 2).sum(1))
    order = np.lexsort((keys[place], score, which))
    which, place, score = which[order], place[order], score[order]
    first = np.searchsorted(which, which)
    kept = np.arange(len(which)) - first < keep
    return queries[which[kept]], keys[place[kept]], score[kept]


def _ranked(points: DataFrame) -> DataFrame:
    """_curve, _rank on it, _key and embedding of every point on every curve."""
    ordered = _keyed(points).repartitionByRange("_curve", "_place", "_key").sortWithinPartitions("_curve", "_place", "_key")
    local = stored(ordered.withColumn("_at", F.monotonically_increasing_id()), "curve-order")
    part = F.shiftright("_at", 33)  # the id's upper bits are the partition, its lower bits count the rows in it
    counted = local.groupBy("_curve", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("_curve", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = local.withColumn("_part", part).join(starts, ["_curve", "_part"])
    return joined.select("_curve", (F.col("_at") - F.col("_first") + F.col("_before")).alias("_rank"), "_key", "embedding")


def _keyed(points: DataFrame) -> DataFrame:
    """_curve, _place (Hilbert key), _key and embedding of every point on every curve."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                y = _projected(_matrix(batch["embedding"].slice(first, 1000)))
                yield pa.RecordBatch.from_pydict({
                    "axis": np.arange(y.shape[1], dtype=np.int32), "n": np.full(y.shape[1], len(y)), "s": y.sum(0), "q": (y * y).sum(0)
                })

    sums = points.select("embedding").mapInArrow(spread, "axis int, n long, s double, q double").groupBy("axis").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "q")]
    )
    moments = np.array([(r["s"] / r["n"], r["q"] / r["n"]) for r in sums.orderBy("axis").collect()]).reshape(-1, 2)  # one row an axis
    mean, deviation = moments[:, 0], np.sqrt(np.maximum(moments[:, 1] - moments[:, 0] ** 2, 1e-30))
    shift = np.random.default_rng(_SEED + 1).uniform(-0.1, 0.1, len(mean))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                unit = 0.5 + shift + (_projected(_matrix(part["embedding"])) - mean) / (8 * deviation)
                cells = (np.clip(unit, 0, 1 - 1e-9) * (1 << BITS)).astype(np.int64)
                for curve, own in enumerate(np.split(cells, CURVES, axis=1)):
                    columns = [pa.array(np.full(len(own), curve, dtype=np.int32)), pa.array(hilbert_keys(own, BITS)), part["_key"], part["embedding"]]
                    yield pa.RecordBatch.from_arrays(columns, ["_curve", "_place", "_key", "embedding"])

    kind = points.schema["embedding"].dataType.simpleString()
    return points.select("_key", "embedding").mapInArrow(place, f"_curve int, _place long, _key long, embedding {kind}")


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _projected(x: np.ndarray) -> np.ndarray:
    """The coordinates of vectors on the axes of all curves, the first curve's first."""
    rng = np.random.default_rng(_SEED)
    width = x.shape[1]
    axes = [np.linalg.qr(rng.normal(size=(width, min(DIMENSIONS, width))))[0] for _ in range(CURVES)]
    return x @ np.hstack(axes)
