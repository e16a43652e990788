"""Vector codes by member-resident Lloyd iteration.

Vectors of integers are cut into equal parts, and each part position has a codebook of its own. A member, one part of one
vector, lives with the owner of its entry: the rows of one (position, entry, salt), which ``repartition`` brings together
and which are written to the shared working folder. A round goes over the members where they are:

* each owner compares its members with the new codebook of their position and writes down which entry is nearest;
* members whose entry stays are read again from where they lie, without a shuffle; only the others migrate, to the
  owners of their new entries, in the next shuffle;
* the entries are updated from the sums and counts that each task takes of the members resident in it.

The number of owners of an entry follows its count, ``OWNER_MEMBERS`` members each, so that an entry that a third of
all parts choose is spread over as many more salts. What reaches the driver are the codebooks, as wide as a vector and
``entries`` long, and one count an entry. A round's folders are deleted once the next is written.

All arithmetic is exact: 64 bits where the magnitudes allow, Python's integers beyond.

Defined results: rows with a null or non-finite component, a null vector, or a length other than the most frequent multiple
of the number of parts take no part; rows are coded one by one, so repeated ones alike; codebooks start from the
smallest vec_ids, null ones last, of several with one vec_id the smallest vectors; with fewer vectors than entries the
codebooks are shorter; an entry nobody chooses stays; ``error`` and ``label_error`` are null where a long cannot hold them;
no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.integer_vectors import exact, integer_vectors, largest, matrix
from clinlake.session import delete_folder, stored, working_folder, working_scope

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Members of one owner, on average at most.
OWNER_MEMBERS = 2048
_ROWS = 4096
_TOO_LARGE = 10**25

_MEMBER = "position int, entry int, row long, part array<long>"
_RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"

#: Entries by position, entry and place within the part.
Codebooks = list[list[list[int]]]


def _distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of every part to every entry, exactly."""
    bound = parts.shape[1] * (largest(parts) + largest(entries)) ** 2
    a, b = exact(parts, bound), exact(entries, bound)
    total = np.zeros((len(a), len(b)), dtype=a.dtype)
    for axis in range(a.shape[1]):
        apart = a[:, axis, None] - b[None, :, axis]
        total += apart * apart
    return total


def _nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part, of several the lowest, and its squared distance."""
    distances = _distances(parts, entries)
    entry = distances.argmin(axis=1)
    return entry, distances[np.arange(len(entry)), entry]


def _decimals(errors: np.ndarray) -> pa.Array:
    """Exact up to what makes a sum too large for a long in any case."""
    if errors.dtype == object:
        return pa.array([Decimal(min(e, _TOO_LARGE)) for e in errors], pa.decimal128(38, 0))
    return pa.array(errors).cast(pa.decimal128(38, 0))


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches, with their positions and parts."""
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            piece = batch.slice(first, _ROWS)
            yield piece, piece["position"].to_numpy(), matrix(piece["part"], width)


def first_vectors(rows: DataFrame, entries: int, parts: int) -> Codebooks:
    """The parts of the vectors with the smallest vec_ids, by position."""
    found = rows.orderBy(F.col("_whole.vec_id").asc_nulls_last(), "_x").limit(entries).select("_x").collect()
    width = len(found[0]["_x"]) // parts
    return [[list(r["_x"][p * width : (p + 1) * width]) for r in found] for p in range(parts)]


def _placed(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Every part of every vector with its nearest entry."""
    tables = [np.array(book, dtype=np.int64) for book in books]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(first, _ROWS)
                x = matrix(piece["_x"], width * len(tables))
                for position, table in enumerate(tables):
                    part = np.ascontiguousarray(x[:, position * width : (position + 1) * width])
                    yield _members(np.full(len(x), position), _nearest(part, table)[0], piece["row"], part)

    return rows.select("row", "_x").mapInArrow(of_batches, _MEMBER)


def _members(position: np.ndarray, entry: np.ndarray, row: pa.Array, part: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(part) + 1) * part.shape[1], pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(position, pa.int32()), pa.array(entry, pa.int32()), row, lists], ["position", "entry", "row", "part"])


def _with_owners(members: DataFrame, counts: dict[tuple[int, int], int], n_entries: int) -> DataFrame:
    """The members brought to their owners: one shuffle by position, entry and salt."""
    n_positions = 1 + max((p for p, _ in counts), default=0)
    salts = F.lit([max(1, -(-counts.get((p, e), 0) // OWNER_MEMBERS)) for p in range(n_positions) for e in range(n_entries)])
    many = F.get(salts, F.col("position") * n_entries + F.col("entry"))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("row", "position"), many))
    return salted.repartition("position", "entry", "salt").sortWithinPartitions("position", "entry", "salt").drop("salt")


def _counts(members: DataFrame) -> dict[tuple[int, int], int]:
    return {(r["position"], r["entry"]): r["count"] for r in members.groupBy("position", "entry").count().collect()}


def _updated(members: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """Every entry replaced by the floored mean of its members."""

    n_entries = len(books[0])

    def sums_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[int]] = {}
        for piece, position, part in _parts(batches, width):
            entry = piece["entry"].to_numpy()
            place = position.astype(np.int64) * n_entries + entry
            order = np.argsort(place, kind="stable")
            part = exact(part, len(part) * largest(part))[order]
            first = np.flatnonzero(np.diff(place[order], prepend=-1))
            n = np.diff(np.append(first, len(order)))
            for at, count, total in zip(place[order][first].tolist(), n.tolist(), np.add.reduceat(part, first, axis=0).tolist(), strict=True):
                own = sums.setdefault(divmod(at, n_entries), [0] * (width + 1))
                sums[divmod(at, n_entries)] = [a + b for a, b in zip(own, [*total, count], strict=True)]
        if sums:
            flat = [(p, e, k, Decimal(v)) for (p, e), own in sums.items() for k, v in enumerate(own)]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat, strict=True), kinds, strict=True)], ["position", "entry", "k", "s"])

    task_sums = members.mapInArrow(sums_of_task, "position int, entry int, k int, s decimal(38,0)")
    total = {(r["position"], r["entry"], r["k"]): int(r["s"]) for r in task_sums.groupBy("position", "entry", "k").agg(F.sum("s").alias("s")).collect()}
    return [
        [
            [total[p, e, k] // total[p, e, width] for k in range(width)] if (p, e, width) in total else own
            for e, own in enumerate(book)
        ]
        for p, book in enumerate(books)
    ]


def _reassigned(members: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """The members with their nearest entry of new codebooks, whether it is another, and their squared distance to it."""
    tables = [np.array(book, dtype=np.int64) for book in books]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, position, part in _parts(batches, width):
            entry, errors = np.empty(len(part), dtype=np.int32), []
            order = np.argsort(position, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(position[order])) + 1):
                entry[own], error = _nearest(part[own], tables[position[own[0]]])
                errors.append(_decimals(error))
            error = pa.concat_arrays(errors).take(pa.array(np.argsort(order)))
            moved = pa.array(entry != piece["entry"].to_numpy())
            kept = [piece["position"], pa.array(entry), piece["row"], piece["part"], moved, error]
            yield pa.RecordBatch.from_arrays(kept, ["position", "entry", "row", "part", "moved", "error"])

    return members.select("position", "entry", "row", "part").mapInArrow(of_batches, f"{_MEMBER}, moved boolean, error decimal(38,0)")


def lloyd(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """row, position, entry and error of every part after the rounds, and the final codebooks."""
    spark, width, books = rows.sparkSession, length // parts, first_vectors(rows, entries, parts)
    n = len(books[0])
    placed, before = _written(_placed(rows, books, width), "lloyd-placed")
    members, folder = _written(_with_owners(placed, _counts(placed), n), "lloyd-members")
    delete_folder(spark, before)
    folders = [folder]
    for _ in range(rounds - 1):
        books = _updated(members, books, width)
        assigned, folder = _written(_reassigned(members, books, width).drop("error"), "lloyd-assigned", "moved")
        residents, migrants = (assigned.filter(F.col("moved") == m).drop("moved") for m in (False, True))
        arrived, second = _written(_with_owners(migrants, _counts(assigned), n), "lloyd-arrived")
        members = residents.unionByName(arrived)
        for old in folders:
            delete_folder(spark, old)
        folders = [folder, second]
    books = _updated(members, books, width)
    return _reassigned(members, books, width).select("row", "position", "entry", "error"), books


def _written(df: DataFrame, purpose: str, *partition_by: str) -> tuple[DataFrame, str]:
    path = working_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that takes part."""
    spark = vectors.sparkSession
    whole = F.struct(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"))
    numbered, length = integer_vectors(vectors, whole, SCALE, parts=parts)
    if not length:
        return spark.createDataFrame([], _RESULT)
    path = working_folder(spark, "lloyd-codes")
    with working_scope(spark):
        # Stored, so that a row keeps its number.
        rows = stored(numbered.withColumn("row", F.monotonically_increasing_id()), "lloyd-rows")
        assigned, books = lloyd(rows, length, parts, entries, rounds)
        place = F.struct("position", F.lower(F.lpad(F.hex("entry"), 2, "0")).alias("digits"))
        by_row = assigned.groupBy("row").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["digits"]), "").alias("code"),
            F.sum("error").alias("_error"),
        )
        codes = rows.select("row", F.col("_whole.*")).join(by_row, "row").select("vec_id", "label", "code", "_error")
        codes.write.parquet(path)
    codes = spark.read.schema(codes.schema).parquet(path)
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("_error").alias("_label_error"))
    numbers = ",".join(str(v) for book in books for entry in book for v in entry)
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        "code",
        F.col("_error").try_cast("long").alias("error"),
        F.col("_label_error").try_cast("long").alias("label_error"),
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )
