"""Vectors as whole numbers, for operators whose results are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums and products of magnitudes below this are exact in 64 bits.
SAFE = 1 << 62


def integer_vectors(vectors: DataFrame, whole: Column, scale: int, shift: int = 0, parts: int = 1) -> tuple[DataFrame, int]:
    """_whole (the column given) and _x, floor(scale * component) + shift as array<long>, with the length of all of them.

    Left out are vectors that are null or hold a null or non-finite component, and those whose length is not the most
    frequent one (of several, the greatest) among the lengths that are multiples of ``parts``; the length is 0 where there
    is none. A product beyond 64 bits counts as the greatest or least number of 64 bits.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    greatest = F.lit((1 << 63) - 1 - shift).cast("long")
    x = F.transform("embedding", lambda c: F.least(F.floor(c.cast("double") * scale), greatest) + F.lit(shift).cast("long"))
    usable = vectors.filter(F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    lengths = usable.groupBy(F.size("embedding").alias("_n")).count().orderBy(F.desc("count"), F.desc("_n")).limit(1).collect()
    length = lengths[0]["_n"] if lengths else 0
    return usable.filter(F.size("embedding") == length).select(whole.alias("_whole"), x.alias("_x")), length


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def largest(*arrays: np.ndarray) -> int:
    """The largest magnitude, as an exact number."""
    return max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)


def exact(array: np.ndarray, bound: int) -> np.ndarray:
    """The array, of Python integers if results up to the bound may not fit 64 bits."""
    return array if bound < SAFE else array.astype(object)


def as_long(value: int) -> int | None:
    """The value, or None where a long cannot hold it."""
    return int(value) if -(1 << 63) <= value < 1 << 63 else None
