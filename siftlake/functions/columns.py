"""Derived columns."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.schemas import PARTITION_COLUMN, ref

log = logging.getLogger(__name__)


def text_length(name: str) -> Column:
    """Characters in a string column, 0 for NULL."""
    return F.coalesce(F.length(ref(name)), F.lit(0))


def stamp_ingest(df: DataFrame) -> DataFrame:
    """Add the ingest time: one value per batch."""
    return df.withColumn("ingested_at", F.current_timestamp())


def with_partition_date(df: DataFrame) -> DataFrame:
    """Add ``ingestion_date`` unless present: the day of ``ingested_at`` in the session zone, else today."""
    if PARTITION_COLUMN in df.columns:
        return df
    if "ingested_at" in df.columns:
        return df.withColumn(PARTITION_COLUMN, F.col("ingested_at").cast("date"))
    log.warning("no ingested_at column; %s is the current date", PARTITION_COLUMN)
    return df.withColumn(PARTITION_COLUMN, F.current_date())


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))
