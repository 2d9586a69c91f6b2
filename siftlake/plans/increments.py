"""Silver and gold kept up to date by what is new, at a cost that follows the new rows and the parts they touch.

Silver is a table in partitions by a hash of the id, each in buckets by id. New rows are joined with the buckets of their
partitions, which need no shuffle for it. What changes is written down first, as pairs of an old and a new row; silver and
gold are then made from the changes, so that a batch which was lost at any point gives the same when it is repeated.

Gold is added up from states per type and day: number, total, least and greatest value. A replaced row is taken out of its
state and the new one put in. What cannot be taken out, an extreme or a fraction, has its type and day counted anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.catalog import ID_PART
from siftlake.operators.layers import EVENT_DATE, recency, silver_events
from siftlake.schemas import quoted
from siftlake.workspace import Scratch, children, exists, remove

# Partitions and buckets of silver. A batch rewrites the partitions it touches, so that there should be many for a large
# table: some hundred MB each, in buckets that a task can sort.
PARTS = 8
BUCKETS = 4

_STAMP = "processed_at"
_GROUP = ("event_type", "event_date")


def id_part(parts: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias(ID_PART)


def as_stored(rows: DataFrame, table: str, parts: int) -> DataFrame:
    """Complete rows, the latest per id, with the columns and types of the silver table."""
    fresh = silver_events(rows)
    columns = [f for f in rows.sparkSession.table(table).schema.fields if f.name != ID_PART]
    cast = [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in columns]
    return fresh.select(*cast).withColumn(ID_PART, id_part(parts))


def silver_changes(stored: DataFrame, fresh: DataFrame, buckets: int) -> DataFrame:
    """``id, id_part, old, new`` of the ids whose fresh row is later than the stored one or the first.

    ``stored`` is a scan of the buckets and takes part as it lies; only ``fresh`` is shuffled.
    """
    columns = [c for c in fresh.columns if c != ID_PART]
    whole = lambda side: F.struct(*[F.col(f"{side}.{quoted(c)}").alias(c) for c in columns])
    ignored = ("id", _STAMP, ID_PART)
    new, old = fresh.repartition(buckets, "id").alias("new"), stored.hint("merge").alias("old")
    there = F.col("old.id").isNotNull()
    later = ~there | (recency(fresh, "new", ignored) > recency(fresh, "old", ignored))
    both = new.join(old, F.col("new.id") == F.col("old.id"), "left").where(later)
    return both.select(
        F.col("new.id").alias("id"), F.col(f"new.{ID_PART}").alias(ID_PART),
        F.when(there, whole("old")).alias("old"), whole("new").alias("new"),
    )


def merged_silver(stored: DataFrame, changes: DataFrame, buckets: int) -> DataFrame:
    """The stored rows without the changed ids, and the new rows. Taking the same changes again gives the same."""
    kept = stored.hint("merge").join(changes.select("id").repartition(buckets, "id"), "id", "left_anti")
    new = changes.select("new.*", ID_PART).repartition(buckets, "id")
    return kept.select(*stored.columns).unionByName(new.select(*stored.columns))


def _total(value_type: T.DataType) -> str:
    return "decimal(38, 0)" if isinstance(value_type, T.IntegralType) else "double"


def _signed(rows: DataFrame) -> list[Column]:
    """What rows with a ``sign`` do to their state: put in for 1, taken out for -1."""
    total = _total(rows.schema["value"].dataType)
    put, out = F.when(F.col("sign") > 0, F.col("value")), F.when(F.col("sign") < 0, F.col("value"))
    return [
        F.sum("sign").cast("long").alias("n"),
        F.sum(F.expr(f"cast(sign AS {total}) * cast(value AS {total})")).cast(total).alias("total"),
        F.min(put).alias("least"), F.max(put).alias("most"), F.min(out).alias("gone_least"), F.max(out).alias("gone_most"),
    ]


def _states(rows: DataFrame) -> DataFrame:
    """Rows with ``sign, type, value, timestamp`` added up by type and day."""
    day = F.expr(EVENT_DATE).alias("event_date")
    return rows.groupBy(F.col("type").alias("event_type"), day).agg(*_signed(rows))


def gold_states(silver: DataFrame) -> DataFrame:
    """``event_type, event_date, n, total, least, most`` of all rows."""
    rows = silver.select(F.lit(1).alias("sign"), "type", "value", "timestamp")
    return _states(rows).drop("gone_least", "gone_most")


def next_states(before: DataFrame | None, changes: DataFrame, silver: DataFrame) -> DataFrame:
    """The states after the changes; ``silver`` is the table after them."""
    sides = [F.struct(F.lit(sign).alias("sign"), *[F.col(f"{side}.{c}") for c in ("type", "value", "timestamp")])
             for side, sign in (("old", -1), ("new", 1))]
    had = F.when(F.col("old").isNotNull(), F.array(*sides)).otherwise(F.array(sides[1]))
    delta = _states(changes.select(F.inline(had)))
    if before is not None:
        value_type = delta.schema["least"].dataType
        none = {c: F.lit(None).cast(value_type) for c in ("gone_least", "gone_most")}
        delta = delta.unionByName(before.withColumns(none))
    sums = delta.groupBy(*_GROUP).agg(
        F.sum("n").alias("n"), F.sum("total").cast(delta.schema["total"].dataType).alias("total"),
        *[F.min(c).alias(c) for c in ("least", "gone_least")], *[F.max(c).alias(c) for c in ("most", "gone_most")],
    )
    fraction = F.lit(_total(delta.schema["least"].dataType) == "double")
    unsure = (F.col("gone_least") <= F.col("least")) | (F.col("gone_most") >= F.col("most")) | fraction
    unsure = F.col("gone_least").isNotNull() & unsure
    sums = sums.withColumn("unsure", unsure)
    anew = sums.where("unsure").select(*[F.col(c).alias(f"_{c}") for c in _GROUP])
    rows = silver.select(F.lit(1).alias("sign"), "type", "value", "timestamp")
    same = F.col("type").eqNullSafe(F.col("_event_type")) & F.expr(EVENT_DATE).eqNullSafe(F.col("_event_date"))
    again = _states(rows.join(anew, same, "left_semi")).drop("gone_least", "gone_most")
    return sums.where("NOT unsure AND n > 0").select(*again.columns).unionByName(again)


def gold_from_states(states: DataFrame, *by: str) -> DataFrame:
    """The metrics of the gold tables: ``event_type`` and with it ``event_date`` when that is asked for."""
    summed = states.groupBy(*by).agg(
        F.sum("n").alias("total_events"), F.sum("total").cast("double").alias("total"), F.min("least").alias("min_value"),
        F.max("most").alias("max_value"),
    )
    return summed.select(
        *by, "total_events", (F.col("total") / F.col("total_events")).alias("avg_value"), "min_value", "max_value",
        F.current_timestamp().alias("calculated_at"),
    )


class Increments:
    """The silver table and the gold states of one flow. ``at`` holds the changes of the last batch and the last states."""

    def __init__(self, spark: SparkSession, table: str, at: str, parts: int = PARTS, buckets: int = BUCKETS):
        self.spark, self.table, self.at, self.parts, self.buckets = spark, table, at.rstrip("/"), parts, buckets

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the versions that were written to their end."""
        names = [n for n in children(self.spark, f"{self.at}/{kind}") if exists(self.spark, f"{self.at}/{kind}/{n}/_SUCCESS")]
        return sorted(int(n.rpartition("=")[2]) for n in names)

    def _path(self, kind: str, number: int) -> str:
        return f"{self.at}/{kind}/number={number}"

    def take(self, rows: DataFrame, number: int) -> int:
        """Merge the rows of a batch into silver and the states; how many ids changed. Batches come in the order of their
        numbers, and the last one may come again."""
        self._write_changes(rows, number)
        changes = self.spark.read.parquet(self._path("changes", number))
        count = changes.count()
        if count:
            # Partitions are as many as was chosen for the table.
            touched = [row[0] for row in changes.select(ID_PART).distinct().collect()]
            stored = self.spark.table(self.table).where(F.col(ID_PART).isin(touched))
            merged_silver(stored, changes, self.buckets).write.insertInto(self.table, overwrite=True)
            earlier = [n for n in self._numbers("states") if n < number]
            before = self.spark.read.parquet(self._path("states", earlier[-1])) if earlier else None
            states = next_states(before, changes, self.spark.table(self.table))
            states.coalesce(1).write.mode("overwrite").parquet(self._path("states", number))
            for old in earlier[:-1]:
                remove(self.spark, self._path("states", old))
        for old in self._numbers("changes"):
            if old < number:
                remove(self.spark, self._path("changes", old))
        return count

    def _write_changes(self, rows: DataFrame, number: int) -> None:
        if number in self._numbers("changes"):
            return  # silver may have taken some of them already, so that they can't be found again
        scratch = Scratch(self.spark, "increment")
        fresh = scratch.settle(as_stored(rows, self.table, self.parts), "fresh")
        touched = [row[0] for row in fresh.select(ID_PART).distinct().collect()]
        stored = self.spark.table(self.table).where(F.col(ID_PART).isin(touched))
        silver_changes(stored, fresh, self.buckets).write.mode("overwrite").parquet(self._path("changes", number))
        scratch.close()

    def states(self) -> DataFrame | None:
        numbers = self._numbers("states")
        return self.spark.read.parquet(self._path("states", numbers[-1])) if numbers else None
