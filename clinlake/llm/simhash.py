"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bits gets a non-zero vector of RADIUS + 1 bits, and table v, a non-zero vector as well, masks the
bits whose vector has an odd product with v. The vectors of at most RADIUS differing bits leave some v at
right angles to all of them, so that a pair within the radius agrees under the mask of a table: no pair is lost.

Within a bucket a pair is confirmed without listing pairs. Two fingerprints differ in at most two bits exactly
when some value is within one bit of both. Every member of a bucket with two or more proposes itself and its
neighbours by one bit outside the mask; who proposes the same value is linked to the smallest that does. A value
has at most 65 proposers, and a bucket's work grows with its members, not with their pairs.

Defined results: a null or wordless text has fingerprint zero; repeated rows are documents of their own; rows with
a null doc_id are linked like any other, but only other doc_ids can name a component (null if there are none);
other columns are ignored, or passed through by ``one_per_component``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.components import smallest_in_component
from clinlake.session import stored

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
#: The confirmation by one-bit neighbours holds for this radius.
RADIUS = 2
_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned SimHash of a text's word shingles, repeats included."""
    words = text.encode().lower().split()  # of bytes: A-Z only, and exactly the blanks of the word rule
    if not words:
        return 0
    if len(words) < shingle_words:
        words = [b" ".join(words)]
        shingle_words = 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words)), strict=False))
    count = len(words) - shingle_words + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=">u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, _AT_ONCE):
        part = hashes[start : start + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, _row (hash of doc_id and text) and fp, the fingerprint as a signed long, of every row."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py()) for t in batch["text"]), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["_row"], pa.array(prints.view(np.int64))], ["doc_id", "_row", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(of_batches, "doc_id long, _row long, fp long")


def row_hash() -> Column:
    return F.xxhash64("doc_id", "text")


def masks(radius: int = RADIUS) -> list[int]:
    """The bit masks of the tables, all but the zero vector's."""
    vectors = [1 + bit % (2 ** (radius + 1) - 1) for bit in range(BITS)]
    return [
        sum(1 << bit for bit, vector in enumerate(vectors) if (vector & table).bit_count() % 2)
        for table in range(1, 2 ** (radius + 1))
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame) -> DataFrame:
    """distinct fp -> edges (a, b) whose components are those of all pairs within RADIUS."""
    tables = masks()
    keyed = prints.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)).bitwiseAND(F.col("fp")) for m in tables])).alias("_table", "_key"))
    shared = keyed.groupBy("_table", "_key").agg(F.min("fp").alias("_low"), F.max("fp").alias("_high")).filter("_low != _high")
    members = keyed.join(shared.select("_table", "_key"), ["_table", "_key"])
    flips = [F.array(*[F.lit(_signed(1 << bit)) for bit in range(BITS) if not mask >> bit & 1], F.lit(0).cast("long")) for mask in tables]
    near = F.transform(F.get(F.array(*flips), F.col("_table")), lambda flip: flip.bitwiseXOR(F.col("fp")))
    proposed = members.select("fp", F.explode(near).alias("_value")).distinct()
    lowest = proposed.groupBy("_value").agg(F.min("fp").alias("_low"), F.max("fp").alias("_high")).filter("_low != _high")
    return proposed.join(lowest, "_value").filter("fp != _low").select(F.col("fp").alias("a"), F.col("_low").alias("b")).distinct()


def components(docs: DataFrame) -> DataFrame:
    """doc_id, _row, fp and component_id, the smallest doc_id reachable over links, of every row."""
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("_first")), "nodes")
    roots = smallest_in_component(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "_first", F.coalesce("smallest", "fp").alias("_root"))
    first = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = rooted.join(first, "_root").select("fp", "component_id", "_root")
    return rows.join(named, "fp")


def one_per_component(docs: DataFrame) -> DataFrame:
    """The document of each component with the smallest doc_id (then row hash), with the columns it came with."""
    return first_of_each(docs, components(docs))


def first_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """The first document of each _root of rows with doc_id, _row and _root."""
    chosen = rooted.groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("_k"))
    keys = chosen.select(*_identity(F.col("_k.doc_id"), F.col("_k._row")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *_identity(F.col("doc_id").cast("long"), row_hash()))
    # The join and the removal of repeats have the same keys, so the texts are shuffled once.
    names = ["_null", "_id", "_row"]
    return whole.join(keys, names, "left_semi").dropDuplicates(names).select("_doc.*")


def _identity(doc_id: Column, row: Column) -> list[Column]:
    return [doc_id.isNull().alias("_null"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("_id"), row.alias("_row")]
