"""Checks of a running stream: a row of counts per micro-batch, kept beside the table."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from siftlake.functions.predicates import is_missing
from siftlake.schemas import CRITICAL_COLUMNS, EVENT_SCHEMA
from siftlake.sources.messages import MessageSource
from siftlake.sources.tables import read_path
from siftlake.streaming.ingest import append_stream, event_stream, finish
from siftlake.workspace import children, write_new

# Seconds to wait for the last reports of a stream that has ended; what comes later is counted from the table.
REPORTS_WITHIN = 5.0
_CAUGHT_UP = "-caught-up"


def _measures(columns: Iterable[str]) -> list:
    """Counts only: they add up over batches, and a stream can't observe distinct values."""
    return [F.count(F.lit(1)).alias("rows"), *(F.count_if(is_missing(c)).alias(f"missing_{c}") for c in columns)]


class BatchCounts:
    """The counts of each micro-batch, a small file each, named by the number of the batch.

    A batch has one file whoever writes it and however often. A batch that was committed but not counted, because the
    driver was lost in between, is made good by ``catch_up`` from the table itself.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Iterable[str] = CRITICAL_COLUMNS):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), tuple(columns)
        self.names = ["rows", *(f"missing_{c}" for c in self.columns)]

    def write(self, batch: int, counts: dict[str, int], suffix: str = "") -> bool:
        text = json.dumps({"batch": batch} | {n: int(counts[n] or 0) for n in self.names})
        return write_new(self.spark, f"{self.path}/{batch:012d}{suffix}.json", text)

    def batches(self) -> dict[str, int]:
        """The batch of each file."""
        return {n: int(n.split(".")[0].split("-")[0]) for n in children(self.spark, self.path) if n.endswith(".json")}

    def rows(self) -> DataFrame:
        """``batch, rows, missing_<column>...``: a row per micro-batch that had rows, and one per time of catching up."""
        schema = T.StructType([T.StructField(n, T.LongType()) for n in ("batch", *self.names)])
        if not self.batches():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(self.path, pathGlobFilter="*.json")

    def catch_up(self, table: DataFrame, committed: Iterable[int]) -> bool:
        """Write what the table holds beyond the rows here as one row, when a committed batch has none; whether it did.

        The stream must not run meanwhile. The difference is taken from the table as a whole, which is one scan of the
        checked columns, and only when a batch is not accounted for.
        """
        known = self.batches()
        covered = max((b for n, b in known.items() if _CAUGHT_UP in n), default=-1)
        missing = {b for b in committed if b > covered} - set(known.values())
        if not missing:
            return False
        held = table.agg(*_measures(self.columns)).first().asDict()
        seen = self.rows().agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in self.names)).first().asDict()
        return self.write(max(committed), {n: held[n] - seen[n] for n in self.names}, _CAUGHT_UP)


class _Listener(StreamingQueryListener):
    """Writes a row for each micro-batch that carries an observation, until it is closed."""

    def __init__(self, counts: BatchCounts, observation: str):
        self.counts, self.observation = counts, observation
        self._lock, self._open = threading.Lock(), True

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(self.observation)
        with self._lock:
            if self._open and observed is not None and event.progress.numInputRows:
                self.counts.write(event.progress.batchId, observed.asDict())

    def close(self) -> None:
        """Nothing is written after this: what has not been heard of by now is caught up with."""
        with self._lock:
            self._open = False

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _committed(spark: SparkSession, checkpoint: str) -> set[int]:
    """The micro-batches that a checkpoint has as done, as far back as Spark keeps them."""
    return {int(n) for n in children(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()}


def ingest_watched(
    spark: SparkSession,
    source: MessageSource,
    path: str,
    checkpoint: str,
    counts: BatchCounts,
    seconds: float | None = None,
    schema: T.StructType = EVENT_SCHEMA,
    charset: str = "utf-8",
    fmt: str = "parquet",
) -> DataFrame:
    """One run from source to raw table with the counts of each micro-batch, taken while it is written; returns the rows of
    all runs so far (``BatchCounts.rows``).

    They appear while the stream runs and nothing is read twice for them. Spark reports a batch after it is committed, so
    the report of a batch may be lost with the driver. The rows add up to the table all the same after each run: batches
    without a row are counted from the table before the run and after it. A table and its counts belong to one checkpoint.
    """

    def catch_up() -> None:
        if committed := _committed(spark, checkpoint):
            counts.catch_up(read_path(spark, path, fmt, merge_schema=True), committed)

    catch_up()
    observation = f"live_checks_{uuid.uuid4().hex}"
    listener = _Listener(counts, observation)
    spark.streams.addListener(listener)
    try:
        stream = event_stream(spark, source, schema, charset).observe(observation, *_measures(counts.columns))
        finish(append_stream(stream, path, checkpoint, fmt, available_now=seconds is None), seconds)
        until = time.monotonic() + REPORTS_WITHIN
        while _committed(spark, checkpoint) - set(counts.batches().values()) and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        listener.close()
        spark.streams.removeListener(listener)
    catch_up()
    return counts.rows()
