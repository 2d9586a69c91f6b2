"""Columns that an operator carries along without looking at them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.schemas import ref


def put_aside(docs: DataFrame, used: Collection[str]) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with all columns but the ``used`` ones under names that clash with nothing, and for each of its columns
    the expression that gives it its own name back."""
    names = {c: c if c.lower() in used else f"aside_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*(ref(c).alias(n) for c, n in names.items())), {c: F.col(n).alias(c) for c, n in names.items()}
