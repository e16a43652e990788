"""Columns made of spans, for the queries that report them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(spans: Column, base_kinds: Sequence[str], is_base: Callable[[Column], Column]) -> list[Column]:
    """n_<kind> of each base kind and base_sha256, of the base spans, and spans, of all."""
    base = F.filter(spans, is_base)
    counts = [F.size(F.filter(base, _is_of(kind))).cast("long").alias(f"n_{kind}") for kind in base_kinds]
    return [*counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans")]


def _is_of(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind
