import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from siftlake.operators.quality import QualitySuite, run_checks
from siftlake.operators.quality_store import PartitionChecks, merged
from siftlake.sinks.exports import write_by_date

SHOWN = ["position", "check", "status", "violations", "detail", "deduction", "findings"]
SUITE = QualitySuite(
    expected_columns={"id", "value", "gone"},
    critical_columns=["id", "type"],
    key_columns=["id", "type"],
    numeric_ranges={"value": (0, 100)},
    partition_column="ingestion_date",
    rules={"known": "type is not null and type not in ('a', 'b')", "small": "value > 1000"},
)


def rows(spark, seed, n, days):
    draw = random.Random(seed)
    data = [
        (
            draw.choice([None, *range(n // 2)]),
            draw.choice([draw.gauss(50, 5), draw.gauss(50, 5), 1e4, -1e6, float("nan"), float("inf"), None])
            if draw.random() < 0.1
            else draw.gauss(1e6 if draw.random() < 0.01 else 50, 5),
            draw.choice(["a", "b", "b�", None]),
            1_700_000_000_000 + draw.randrange(50_000_000),
            draw.choice(days),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "id long, value double, type string, big long, day string").select(
        "id", "value", "type", "big", F.lit(7).alias("same"), F.to_date("day").alias("ingestion_date")
    )


def by_partition(spark, path, store, suite=SUITE):
    return sorted(map(tuple, PartitionChecks(spark, path, store, suite).results().select(SHOWN).collect()))


def at_once(spark, path, suite=SUITE):
    return sorted(map(tuple, run_checks(spark.read.option("mergeSchema", "true").parquet(path), suite).select(SHOWN).collect()))


@pytest.fixture
def dataset(spark, tmp_path):
    path = str(tmp_path / "data")
    write_by_date(rows(spark, 1, 300, ["2024-01-01", "2024-01-02", "2024-01-03", None]), path)
    return path, str(tmp_path / "store")


def test_equal_to_the_full_run_after_each_change(spark, dataset):
    path, store = dataset
    assert by_partition(spark, path, store) == at_once(spark, path)
    # A new date, a date written again and a second file in another.
    write_by_date(rows(spark, 2, 200, ["2024-01-02", "2024-01-09"]), path, replace_all=False)
    rows(spark, 3, 50, ["2024-01-03"]).write.mode("append").partitionBy("ingestion_date").parquet(path)
    assert PartitionChecks(spark, path, store, SUITE).refresh() == 3
    assert by_partition(spark, path, store) == at_once(spark, path)
    # Dates that are gone.
    write_by_date(rows(spark, 4, 100, ["2024-01-09", "2024-02-01"]), path)
    assert by_partition(spark, path, store) == at_once(spark, path)
    assert PartitionChecks(spark, path, store, SUITE).refresh() == 0


def test_spread_is_that_of_all_rows(spark, dataset):
    path, store = dataset
    checks = PartitionChecks(spark, path, store, SUITE)
    checks.refresh()
    found = merged(checks._kept(checks._states(), 0)).first()
    data = spark.read.parquet(path)
    for i, c in enumerate(checks.numeric):
        finite = data.where(F.abs(F.col(c)) < float("inf")).agg(F.avg(c).alias("a"), F.stddev(c).alias("s"), F.count(c).alias("n")).first()
        assert found[f"avg_{i}"] == pytest.approx(finite.a, rel=1e-9)
        assert found[f"stddev_{i}"] == pytest.approx(finite.s, rel=1e-9)
        assert found[f"n_{i}"] == finite.n


def test_only_changed_partitions_are_read(spark, dataset):
    path, store = dataset
    checks = PartitionChecks(spark, path, store, SUITE)
    assert checks.refresh() == 4
    # Whoever opened a file of the other dates would fail: their bytes are gone, sizes and times are as they were.
    for file in glob.glob(f"{path}/ingestion_date=2024-01-0[12]/*.parquet"):
        times, size = os.stat(file), os.path.getsize(file)
        with open(file, "wb") as broken:
            broken.write(b"x" * size)
        os.utime(file, ns=(times.st_atime_ns, times.st_mtime_ns))
    rows(spark, 5, 40, ["2024-01-03"]).write.mode("append").partitionBy("ingestion_date").parquet(path)
    assert PartitionChecks(spark, path, store, SUITE).refresh() == 1


def test_new_columns_and_rules_are_measured_anew_and_points_are_not(spark, dataset):
    path, store = dataset
    PartitionChecks(spark, path, store, SUITE).refresh()
    softer = QualitySuite(**{**SUITE.__dict__, "sigma": 1.0, "min_rows": 10_000})
    assert PartitionChecks(spark, path, store, softer).refresh() == 0
    assert by_partition(spark, path, store, softer) == at_once(spark, path, softer)
    other = QualitySuite(**{**SUITE.__dict__, "rules": {"small": "value > 10"}})
    assert PartitionChecks(spark, path, store, other).refresh() == 4
    wider = rows(spark, 6, 30, ["2024-01-03"]).withColumn("more", F.lit("x"))
    write_by_date(wider, path, replace_all=False)
    assert by_partition(spark, path, store) == at_once(spark, path)


def test_a_rule_that_fails_on_one_partition_fails_alone(spark, dataset):
    path, store = dataset
    suite = QualitySuite(
        rules={"breaks": "if(ingestion_date = '2024-01-02', raise_error('no'), false)", "holds": "false"}
    )
    assert by_partition(spark, path, store, suite) == at_once(spark, path, suite)


def test_many_columns_in_several_scans(spark, tmp_path):
    path = str(tmp_path / "wide")
    columns = [(F.col("id") % (i + 2)).alias(f"c{i}") for i in range(15)]
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("ingestion_date")
    write_by_date(spark.range(500).select("id", *columns, day), path)
    suite = QualitySuite(critical_columns=[f"c{i}" for i in range(15)], sigma=1.0)
    checks = PartitionChecks(spark, path, str(tmp_path / "store"), suite)
    assert len(checks.scans) > 1
    assert by_partition(spark, path, str(tmp_path / "store"), suite) == at_once(spark, path, suite)


def test_a_lost_run_goes_on(spark, dataset, monkeypatch):
    path, store = dataset
    checks = PartitionChecks(spark, path, store, SUITE)
    monkeypatch.setattr("siftlake.operators.quality_store.PARTITIONS_PER_BATCH", 2)
    write, calls = PartitionChecks._write, []

    def dies(self, *given):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        write(self, *given)

    monkeypatch.setattr(PartitionChecks, "_write", dies)
    with pytest.raises(RuntimeError):
        checks.refresh()
    assert PartitionChecks(spark, path, store, SUITE).refresh() == 2
    assert by_partition(spark, path, store) == at_once(spark, path)


def test_what_cannot_be_kept(spark, dataset):
    path, store = dataset
    with pytest.raises(ValueError):
        PartitionChecks(spark, path, store, QualitySuite(rules={"all": lambda df: True}))
    with pytest.raises(ValueError):
        PartitionChecks(spark, path, store, QualitySuite(), partition="day")
