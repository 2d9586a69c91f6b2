"""Test events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of a test event: its type, and its value per id.
TEST_TYPE = "test_event"
VALUE_PER_ID = 10
DEMO_EVENTS = 50


def events_for(
    ids: DataFrame, column: str = "id", sent_at: Column | None = None, types: Sequence[str] = (TEST_TYPE,)
) -> DataFrame:
    """One event per id: ``id, value = 10 * id, type, timestamp`` in epoch milliseconds, the types taking turns."""
    key = F.col(column)
    kind = F.element_at(F.array(*map(F.lit, types)), F.pmod(key, F.lit(len(types))).cast("int") + 1)
    return ids.select(
        key.alias("id"),
        (key * VALUE_PER_ID).alias("value"),
        kind.alias("type"),
        F.unix_millis(F.current_timestamp() if sent_at is None else sent_at.cast("timestamp")).alias("timestamp"),
    )


def generate_events(spark: SparkSession, n: int = DEMO_EVENTS, **options) -> DataFrame:
    """``n`` events with ids from 0, made on the executors."""
    return events_for(spark.range(n), **options)
