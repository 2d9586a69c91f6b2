"""Violation predicates. Each is TRUE for a bad row and never NULL-counts a good one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftlake.functions.codec import REPLACEMENT
from siftlake.schemas import ref


def is_missing(name: str) -> Column:
    return ref(name).isNull()


def outside(value: Column, low, high) -> Column:
    """Outside the closed range; NULL is not a violation."""
    return (value < F.lit(low)) | (value > F.lit(high))


def out_of_range(name: str, low, high) -> Column:
    return outside(ref(name), low, high)


def is_negative(name: str) -> Column:
    return ref(name) < 0


def not_in_set(name: str, allowed: Iterable) -> Column:
    """Not one of the allowed values; NULL is a violation."""
    return ref(name).isNull() | ~ref(name).isin(*allowed)


def has_bad_characters(name: str) -> Column:
    """Holds the Unicode replacement character, the trace of a failed decode."""
    return ref(name).contains(REPLACEMENT)


def matches(condition: str | None) -> Column:
    """A user's SQL predicate as a strict TRUE/FALSE; no predicate matches every row."""
    if condition is None:
        return F.lit(True)
    return F.coalesce(F.expr(condition), F.lit(False))
