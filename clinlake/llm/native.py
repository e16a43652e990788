"""Small helpers for operators that stay in built-in functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of the word rule ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The maximal runs of other than blank characters, in order."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def without(text: Column, characters: str) -> Column:
    """The text without these characters."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)
