"""Packing by best-fit decreasing.

A document longer than a window is first cut into full windows; what is left of it, and every shorter document,
is a piece. Pieces go longest first, each into the open window with the least room that still holds it, which a
segment tree indexed by remaining capacity finds.

The outcome depends on the lengths alone, of which there are at most as many as a window has tokens. So only
the count of each length is gathered, the best fit is worked out for runs of equal pieces over runs of equal
windows, and each piece finds its place in that plan by its rank among the pieces of its length. A full window is a
sequence by itself and needs no rank: it is numbered where it lies. The others are ranked in salted groups of about
``GROUP_ROWS`` pieces and at least ``SALTS`` groups a length, so that no length, however common, is one task. What reaches
the driver is one count a length, at any size of the corpus; the packing is that of one global best fit. Sequence ids are
distinct, but not without gaps.

Defined results: a null or empty text is a piece of one token, the end mark; repeated rows are packed each; an empty
table has no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from clinlake.llm.bpe import library_encoder
from clinlake.session import stored

WINDOW = 2048
END_ID = 1
SALTS = 32
GROUP_ROWS = 1 << 16


def pieces(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, start, length, doc_tokens and ids (little-endian unsigned 32 bits) of every piece of every document."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library_encoder(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                yield _cut(batch.slice(first, 500), own)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(of_batches, "doc_id long, start long, length long, doc_tokens long, ids binary")


def _cut(batch: pa.RecordBatch, own) -> pa.RecordBatch:
    rows = []
    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
        ids = own.encode(text.as_py())
        ids.append(END_ID)
        raw = np.frombuffer(ids, dtype=np.uint32).astype("<u4").tobytes()
        n = len(ids)
        rows += [(doc_id, at, min(WINDOW, n - at), n, raw[4 * at : 4 * (at + WINDOW)]) for at in range(0, n, WINDOW)]
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "length", "doc_tokens", "ids"]
    )


class CapacityTree:
    """A segment tree over remaining capacities: which ones have an open window, and the least that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        node = size + self.leaves
        if self.open[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, first window, pieces a window, offset) of each run.

    The pieces of a run fill windows from the first on, so many in each, the last perhaps fewer; a run ends where
    the next one of its length begins.
    """
    tree, rooms, n_windows, plan = CapacityTree(window), {}, 0, []

    def leave_open(room: int, first: int, last: int) -> None:
        if room and first < last:
            rooms.setdefault(room, []).append((first, last))
            tree.mark(room, True)

    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        rank, total = 0, counts[size]
        while rank < total:
            room = tree.tightest(size)
            if room is None:
                room = window
                each = room // size
                first, last = n_windows, n_windows + -(-(total - rank) // each)
                n_windows = last
            else:
                each = room // size
                first, last = rooms[room].pop()
                if not rooms[room]:
                    tree.mark(room, False)
            used = min(last - first, -(-(total - rank) // each))
            placed = min(used * each, total - rank)
            plan.append((size, rank, first, each, window - room))
            full, over = divmod(placed, each)
            leave_open(room - each * size, first, first + full)
            leave_open(room - over * size, first + full, first + used)
            leave_open(room, first + used, last)
            rank += placed
    return plan


def place(rows: DataFrame) -> DataFrame:
    """Pieces (doc_id, start, length and any others) with sequence_id and offset, the place of each."""
    # Stored, so that a piece keeps its number, by which equal pieces are told apart.
    kept = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    full = kept.filter(F.col("length") == WINDOW).drop("_at")
    # No packing has more sequences than pieces, so ids from there on are free.
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() + sum(counts.values())).withColumn("offset", F.lit(0).cast("long"))
    return _placed_by_rank(_ranked(kept.filter(F.col("length") < WINDOW), counts), rows, counts).unionByName(alone)


def _ranked(kept: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Pieces with _rank, from 0, among those of their length."""
    salts = F.lit([max(SALTS, -(-counts.get(length, 0) // GROUP_ROWS)) for length in range(WINDOW)])
    salted = kept.withColumn("_salt", F.pmod(F.xxhash64("_at"), F.get(salts, F.col("length").cast("int"))))
    groups = salted.groupBy("length", "_salt").count()
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    in_group = Window.partitionBy("length", "_salt").orderBy("_at")
    ranked = salted.withColumn("_n", F.row_number().over(in_group))
    return ranked.join(starts, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_n") - 1)


def _placed_by_rank(ranked: DataFrame, rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    plan = np.array(sorted(best_fit_decreasing({s: n for s, n in counts.items() if s < WINDOW})), dtype=np.int64).reshape(-1, 5)
    shared = rows.sparkSession.sparkContext.broadcast(plan)
    columns = list(rows.columns)
    schema = StructType(list(rows.schema.fields)).add("sequence_id", LongType()).add("offset", LongType())

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        first_of_length = np.searchsorted(runs[:, 0], np.arange(WINDOW + 2))
        for batch in batches:
            length, rank = (np.asarray(batch[c]) for c in ("length", "_rank"))
            run = np.empty(len(rank), dtype=np.int64)
            for size in np.unique(length):
                here = length == size
                low, high = first_of_length[size], first_of_length[size + 1]
                run[here] = low + np.searchsorted(runs[low:high, 1], rank[here], side="right") - 1
            _, first_rank, first_window, each, offset = runs[run].T
            behind = rank - first_rank
            found = [pa.array(first_window + behind // each), pa.array(offset + behind % each * length)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), *found], [*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "_rank").mapInArrow(of_batches, schema)
