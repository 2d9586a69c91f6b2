"""Silver and gold by increments against filling them as a whole."""

import random
import re

import pytest
from pyspark.sql import functions as F

from siftlake import catalog
from siftlake.operators.layers import gold_by_type_and_date, gold_metrics, silver_events
from siftlake.plans import increments as inc
from siftlake.plans.flow import fill_layers
from siftlake.sinks.exports import write_by_date
from siftlake.sources.tables import read_path

DAY = 86_400_000
EVENTS = "id long, value {}, type string, timestamp long, kafka_partition int, kafka_offset long, ingested_at timestamp"


def batches(value, n=5, size=120, seed=1):
    """Events with late, repeated and equal rows, nulls, and values that are extremes for a while."""
    rnd, offset, found = random.Random(seed), 0, []
    for _ in range(n):
        rows = []
        for _ in range(size):
            offset += 1
            amount = rnd.choice([None, -1, 0, 1, 2, 3, 1000])
            amount = float(amount) / 7 if value == "double" and amount is not None else amount
            when = rnd.choice([0, 1, DAY, 2 * DAY, 10**15 * 300, rnd.randrange(3 * DAY)])
            rows.append((rnd.randrange(60), amount, rnd.choice(["a", "b", "c", None]), when, 0, offset, None))
        found.append(rows + rows[:5])
    return found


def store(spark, tmp_path, name, value="int", parts=8, buckets=4):
    (_, silver, _) = catalog.create_layers(spark, name, str(tmp_path / "layers"))
    schema = silver_events(spark.createDataFrame([], EVENTS.format(value))).schema
    table = catalog.create_silver_table(spark, silver, schema, buckets=buckets)
    return inc.Increments(spark, table, str(tmp_path / "at"), parts, buckets)


def rows_of(df, *drop):
    return sorted((tuple(r) for r in df.drop("processed_at", "calculated_at", catalog.ID_PART, *drop).collect()), key=repr)


def check_all(spark, held, seen):
    whole = silver_events(seen)
    silver = spark.table(held.table)
    assert rows_of(silver.select(*whole.columns)) == rows_of(whole)
    rounded = lambda df: df.withColumn("avg_value", F.round("avg_value", 9))
    for expected, by in ((gold_metrics(whole), ["event_type"]), (gold_by_type_and_date(whole), ["event_type", "event_date"])):
        found = inc.gold_from_states(held.states(), *by)
        assert rows_of(rounded(found).select(*expected.columns)) == rows_of(rounded(expected))


@pytest.mark.parametrize("value", ["int", "double"])
def test_increments_equal_the_whole(spark, tmp_path, value):
    held = store(spark, tmp_path, f"inc_{value}_", value)
    schema, seen = EVENTS.format(value), []
    for number, rows in enumerate(batches(value)):
        seen += rows
        held.take(spark.createDataFrame(rows, schema), number)
        if number % 2 == 0:
            check_all(spark, held, spark.createDataFrame(seen, schema))
    assert held.take(spark.createDataFrame(seen, schema), 9) == 0


@pytest.mark.parametrize("step", ["merged_silver", "next_states"])
def test_a_batch_lost_half_way_gives_the_same(spark, tmp_path, monkeypatch, step):
    held, schema = store(spark, tmp_path, f"lost_{step}_"), EVENTS.format("int")
    first, second = batches("int", 2)
    held.take(spark.createDataFrame(first, schema), 0)

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(inc, step, lost)
    with pytest.raises(RuntimeError, match="lost"):
        held.take(spark.createDataFrame(second, schema), 1)
    monkeypatch.undo()
    held.take(spark.createDataFrame(second, schema), 1)
    check_all(spark, held, spark.createDataFrame(first + second, schema))


def nodes_above(lines, i):
    """The first words of the nodes from a line of a plan up to its first join."""
    begin, found = lambda line: re.search("[A-Z]", line).start(), []
    depth = begin(lines[i])
    while i and "SortMergeJoin" not in found:
        i -= 1
        if lines[i].strip() and begin(lines[i]) < depth:
            depth = begin(lines[i])
            found.append(lines[i][depth:].split()[0])
    return found


def test_stored_rows_are_not_shuffled_and_untouched_parts_not_rewritten(spark, tmp_path):
    held, schema = store(spark, tmp_path, "plan_"), EVENTS.format("int")
    rows = [(i, 1, "a", i, 0, i, None) for i in range(400)]
    held.take(spark.createDataFrame(rows, schema), 0)
    files = lambda: set(spark.table(held.table).inputFiles())
    before = files()
    fresh = inc.as_stored(spark.createDataFrame([(7, 5, "b", 900, 0, 900, None)], schema), held.table, held.parts)
    part = fresh.first()[catalog.ID_PART]
    stored = spark.table(held.table).where(F.col(catalog.ID_PART) == part)
    changes = inc.silver_changes(stored, fresh, held.buckets)
    for planned in (changes, inc.merged_silver(stored, changes, held.buckets)):
        lines = planned._jdf.queryExecution().executedPlan().toString().splitlines()
        scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
        assert scans and not any("Broadcast" in line for line in lines)
        for i in scans:
            assert "Bucketed: true" in lines[i] and catalog.ID_PART in re.search(r"PartitionFilters: \[(.*?)\]", lines[i])[1]
            above = nodes_above(lines, i)
            assert "SortMergeJoin" in above and not any("Exchange" in node for node in above)
    assert held.take(spark.createDataFrame([(7, 5, "b", 900, 0, 900, None)], schema), 1) == 1
    gone = before - files()
    assert gone and all(f"{catalog.ID_PART}={part}/" in file for file in gone)
    check_all(spark, held, spark.createDataFrame([*rows, (7, 5, "b", 900, 0, 900, None)], schema))


def test_layers_by_increments(spark, tmp_path):
    export, at = str(tmp_path / "export"), str(tmp_path / "layers")
    dated = lambda rows: spark.createDataFrame(rows, EVENTS.format("int")).withColumn(
        "ingestion_date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("kafka_offset") % 3).cast("int"))
    )
    first, second, third = batches("int", 3)
    write_by_date(dated(first), export)
    fill_layers(spark, export, at, "fill_")
    write_by_date(dated(first + second), export)
    fill_layers(spark, export, at, "fill_")
    extra = dated(third).withColumn("note", F.lit("n"))
    extra.write.mode("append").partitionBy("ingestion_date").parquet(export)
    listed = fill_layers(spark, export, at, "fill_")
    assert [tuple(r)[:3] for r in listed.collect()] == [
        ("events_raw", "fill_bronze", "EXTERNAL"),
        ("events_by_type", "fill_gold", "VIEW"),
        ("events_by_type_and_date", "fill_gold", "VIEW"),
        ("events_metrics", "fill_gold", "MANAGED"),
        ("events_metrics_by_date", "fill_gold", "MANAGED"),
        ("events_cleaned", "fill_silver", "MANAGED"),
    ]
    whole = silver_events(read_path(spark, export, merge_schema=True))
    for _ in range(2):
        assert rows_of(spark.table("fill_silver.events_cleaned").select(*whole.columns)) == rows_of(whole)
        for name, view, expected in (
            ("events_metrics", "events_by_type", gold_metrics(whole)),
            ("events_metrics_by_date", "events_by_type_and_date", gold_by_type_and_date(whole)),
        ):
            rounded = expected.withColumn("avg_value", F.round("avg_value", 9))
            for table in (name, view):
                found = spark.table(f"fill_gold.{table}").withColumn("avg_value", F.round("avg_value", 9))
                assert rows_of(found.select(*rounded.drop("calculated_at").columns)) == rows_of(rounded)
        fill_layers(spark, export, at, "fill_", rebuild=True)
