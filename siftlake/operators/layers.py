"""Silver and gold: cleaned events and the metrics over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.schemas import CRITICAL_COLUMNS, PARTITION_COLUMN, quoted, ref


# What makes a row of the same id the later one, most important first.
_RECENCY = ("timestamp", "kafka_offset", "kafka_partition")


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _by_recency(df: DataFrame, without: Sequence[str] = ("id",)) -> tuple[list[str], list[str]]:
    """The columns that say which of two rows is the later one, in order, and those that have no order."""
    columns = [c for c in _RECENCY if c in df.columns]
    columns += [c for c in df.columns if c not in columns and c not in without]
    unordered = [c for c in columns if not _has_order(df.schema[c].dataType)]
    return [c for c in columns if c not in unordered], unordered


def _tie(columns: Sequence[Column]) -> Column:
    return F.xxhash64(F.to_json(F.struct(*columns))).alias("tie")


def recency(df: DataFrame, side: str, without: Sequence[str]) -> Column:
    """What is greater for the later of two rows, as in ``latest_by_id``; of a joined table's ``side``."""
    order, unordered = _by_recency(df, without)
    named = lambda c: F.col(f"{side}.{quoted(c)}")
    return F.struct(*[named(c) for c in order], *([_tie([named(c) for c in unordered])] if unordered else []))


def latest_by_id(df: DataFrame) -> DataFrame:
    """One row per id: the latest by event time, then message offset, then message partition, then all other columns
    that have an order, then a hash of the others as JSON.

    The row is a maximum, so every task keeps one row per id it saw before anything is shuffled: an id that holds a
    third of the table sends a row per task, not a third of the table, to one reducer. A rank over a window gives the
    same rows but sorts them on every column of the order, which took two thirds longer.
    """
    order, unordered = _by_recency(df)
    ordered = [ref(c) for c in order]
    if unordered:
        rest = [ref(c) for c in unordered]
        newest = F.max_by(F.struct(*ordered, *rest), F.struct(*ordered, _tie(rest))).alias("newest")
    else:
        newest = F.max(F.struct(*ordered)).alias("newest")
    return df.groupBy("id").agg(newest).select("id", "newest.*").select(*[ref(c) for c in df.columns])


def silver_events(bronze: DataFrame, critical: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Events with all critical fields, once per id, stamped with the processing time."""
    complete = bronze.drop(PARTITION_COLUMN)
    for name in critical:  # plain IS NOT NULL filters reach the Parquet reader, dropna does not
        complete = complete.filter(ref(name).isNotNull())
    return latest_by_id(complete).withColumn("processed_at", F.current_timestamp())


# The day of an event; none for a time outside the years 1 to 9999, which no date can be made of.
EVENT_DATE = (
    "CASE WHEN timestamp BETWEEN -62135596800000 AND 253402300799999 THEN cast(timestamp_millis(timestamp) AS date) END"
)


def _metrics() -> list:
    return [
        F.count(F.lit(1)).alias("total_events"),
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    ]


def gold_metrics(silver: DataFrame) -> DataFrame:
    """``event_type, total_events, avg_value, min_value, max_value, calculated_at``."""
    return (
        silver.groupBy(F.col("type").alias("event_type"))
        .agg(*_metrics())
        .withColumn("calculated_at", F.current_timestamp())
    )


def gold_by_type_and_date(silver: DataFrame) -> DataFrame:
    """The same metrics per type and day of the event."""
    day = F.expr(EVENT_DATE).alias("event_date")
    return (
        silver.groupBy(F.col("type").alias("event_type"), day)
        .agg(*_metrics())
        .withColumn("calculated_at", F.current_timestamp())
    )


def create_gold_views(spark: SparkSession, silver_name: str, views_in: str | None = None) -> tuple[str, str]:
    """SQL views for reports over a silver table, always current: per type, and per type and day.

    ``views_in`` names the schema for persistent views; without it the views last as long as the session and
    ``silver_name`` may be a session view too.
    """
    kind, prefix = ("VIEW", f"{views_in}.") if views_in else ("TEMPORARY VIEW", "")
    metrics = "count(*) AS total_events, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value"
    per_type, per_day = f"{prefix}events_by_type", f"{prefix}events_by_type_and_date"
    spark.sql(
        f"CREATE OR REPLACE {kind} {per_type} AS "
        f"SELECT type AS event_type, {metrics} FROM {silver_name} GROUP BY type"
    )
    spark.sql(
        f"CREATE OR REPLACE {kind} {per_day} AS "
        f"SELECT type AS event_type, {EVENT_DATE} AS event_date, {metrics} "
        f"FROM {silver_name} GROUP BY ALL"
    )
    return per_type, per_day
