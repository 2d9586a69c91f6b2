"""Messages to a raw table: append-only, map-only streams with a checkpoint."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siftlake.functions.codec import parse_messages
from siftlake.functions.columns import stamp_ingest
from siftlake.operators.profile import dataset_stats
from siftlake.operators.quality import QualitySuite, run_checks, settled
from siftlake.schemas import CRITICAL_COLUMNS, EVENT_SCHEMA
from siftlake.sources.messages import MessageSource
from siftlake.sources.schema_log import SchemaLog
from siftlake.sources.tables import read_path


def event_stream(
    spark: SparkSession, source: MessageSource, schema: T.StructType = EVENT_SCHEMA, charset: str = "utf-8"
) -> DataFrame:
    """Typed events with message metadata and ingest time."""
    return stamp_ingest(parse_messages(source.stream(spark), schema, charset))


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append a stream to a dataset. Restarting with the same checkpoint goes on where the last run stopped, without
    loss or repetition. ``available_now`` takes what is there and ends; otherwise the query runs until stopped.
    New columns of the stream become a version of the schema log beside a Parquet dataset."""
    if fmt == "parquet":
        SchemaLog.beside(stream.sparkSession, path).add(stream.schema)
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")  # for formats with a log of their own
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def finish(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for a query to end, or for a fixed time and then stop it."""
    if seconds is None:
        query.awaitTermination()
        return
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


@dataclass(frozen=True)
class IngestCheck:
    """What the raw table looks like after a run: null check, statistics, and whether it holds any row."""

    nulls: DataFrame
    stats: DataFrame
    succeeded: bool


def check_ingested(spark: SparkSession, path: str, fmt: str = "parquet") -> IngestCheck:
    table = read_path(spark, path, fmt, merge_schema=True)
    nulls = settled(run_checks(table, QualitySuite(critical_columns=CRITICAL_COLUMNS), only=["nulls"]))
    stats = settled(dataset_stats(table))
    return IngestCheck(nulls, stats, stats.first()["total_rows"] > 0)


def ingest_events(
    spark: SparkSession,
    source: MessageSource,
    path: str,
    checkpoint: str,
    seconds: float | None = None,
    schema: T.StructType = EVENT_SCHEMA,
    charset: str = "utf-8",
    fmt: str = "parquet",
) -> IngestCheck:
    """One run from source to raw table: drains what is there, or runs for ``seconds``; then checks the table."""
    stream = event_stream(spark, source, schema, charset)
    finish(append_stream(stream, path, checkpoint, fmt, available_now=seconds is None), seconds)
    return check_ingested(spark, path, fmt)
