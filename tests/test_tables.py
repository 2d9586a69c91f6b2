import uuid

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from siftlake import catalog, workspace
from siftlake.operators import layers, mutations
from siftlake.plans import lake_validation
from siftlake.plans.export import gated_export
from siftlake.plans.flow import fill_layers
from siftlake.schemas import BRONZE_SCHEMA
from siftlake.sinks.exports import write_by_date, write_plain
from siftlake.sources.files import incremental_parquet
from siftlake.sources.generated import events_for, generate_events
from siftlake.sources.tables import read_path, read_table

DAY = datetime.date(2024, 1, 1)


def bronze(spark, n=50, days=3):
    return generate_events(spark, n).select(
        F.col("id").cast("int"),
        F.col("value").cast("int"),
        "type",
        "timestamp",
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        F.lit("2024-01-01 12:00:00").cast("timestamp").alias("ingested_at"),
        F.date_add(F.lit(DAY), (F.col("id") % days).cast("int")).alias("ingestion_date"),
    )


def dates(df):
    return sorted({str(r[0]) for r in df.select("ingestion_date").collect()})


def test_generated_events(spark):
    rows = generate_events(spark).orderBy("id").collect()
    assert [(r.id, r.value, r.type) for r in rows] == [(i, 10 * i, "test_event") for i in range(50)]
    assert len({r.timestamp for r in rows}) == 1 and 1_600_000_000_000 < rows[0].timestamp < 9_999_999_999_999
    kinds = events_for(spark.range(4), types=("a", "b", "c")).orderBy("id").collect()
    assert [r.type for r in kinds] == ["a", "b", "c", "a"]


def test_export_replaces_everything_or_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "x")
    write_by_date(bronze(spark), path)
    assert dates(read_path(spark, path)) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    second = bronze(spark).filter("ingestion_date = '2024-01-02'").limit(1)
    write_by_date(second, path, replace_all=False)
    assert read_path(spark, path).groupBy("ingestion_date").count().filter("count = 1").count() == 1
    assert len(dates(read_path(spark, path))) == 3
    write_by_date(second, path)
    assert dates(read_path(spark, path)) == ["2024-01-02"]


@pytest.mark.parametrize("rebalance", [True, False])
def test_export_keeps_all_rows_and_adds_the_date(spark, tmp_path, rebalance):
    path = str(tmp_path / "x")
    write_by_date(bronze(spark).drop("ingestion_date"), path, rebalance=rebalance, max_records_per_file=20)
    assert read_path(spark, path).count() == 50 and dates(read_path(spark, path)) == ["2024-01-01"]


def test_scattered_dates_are_gathered_first(spark, tmp_path):
    path = tmp_path / "x"
    write_by_date(bronze(spark, 3000).repartition(16), str(path))
    assert len(list(path.glob("*/*.parquet"))) == 3


def test_dates_in_order_are_written_without_a_shuffle(spark, tmp_path):
    ordered = bronze(spark, 3000).withColumn(
        "ingestion_date", F.date_add(F.lit(DAY), F.floor(F.col("id") / 600).cast("int"))
    )
    write_by_date(ordered, str(tmp_path / "x"), rebalance=False)
    files = len(list((tmp_path / "x").glob("*/*.parquet")))
    assert 5 < files <= 5 + spark.sparkContext.defaultParallelism
    assert read_path(spark, str(tmp_path / "x")).count() == 3000


def test_gate(spark, tmp_path):
    good = gated_export(bronze(spark), str(tmp_path / "good"))
    assert good.exported and good.report.first().quality_score == 100
    assert read_path(spark, str(tmp_path / "good")).count() == 50
    bad = gated_export(bronze(spark).withColumn("type", F.lit("other")), str(tmp_path / "bad"))
    assert not bad.exported and not (tmp_path / "bad").exists()
    empty = gated_export(bronze(spark).limit(0), str(tmp_path / "empty"))
    assert not empty.exported and empty.results.filter("check = 'row_count'").first().status == "FAIL"


def test_plain_write_and_read(spark, tmp_path):
    path = str(tmp_path / "x")
    write_plain(spark.range(10).select("id", (F.col("id") * 2).alias("value")), path)
    write_plain(spark.range(5).select("id", (F.col("id") * 100).alias("value")), path)
    assert read_path(spark, path).agg(F.sum("value")).first()[0] == 1000


def test_read_unites_columns_after_a_schema_change(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(2).write.parquet(path)
    spark.range(2).withColumn("extra", F.lit(1)).write.mode("append").parquet(path)
    assert set(read_path(spark, path, merge_schema=True).columns) == {"id", "extra"}
    assert set(incremental_parquet(spark, path).columns) == {"id", "extra"}


@pytest.mark.parametrize(
    "condition, kept", [("v > 1", [None, 1]), ("v is null", [1, 2]), ("v < 0", [None, 1, 2]), (None, [])]
)
def test_delete_keeps_rows_whose_predicate_is_false_or_null(spark, tmp_path, condition, kept):
    path = str(tmp_path / "x")
    spark.createDataFrame([(1,), (2,), (None,)], "v int").write.parquet(path)
    preview = mutations.delete_preview(read_path(spark, path), condition).first()
    assert tuple(preview) == (3, 3 - len(kept))
    target, counts = mutations.delete_from_path(spark, path, condition, str(tmp_path / "y"))
    assert tuple(counts.first()) == (3, 3 - len(kept), len(kept))
    left = [r.v for r in spark.read.schema("v int").parquet(target).collect()]
    assert sorted(left, key=lambda v: (v is not None, v)) == kept
    assert read_path(spark, path).count() == 3


def make_table(spark, tmp_path, name, df):
    path = str(tmp_path / name)
    write_by_date(df, path)
    (layer, *_) = catalog.create_layers(spark, f"{name}_", str(tmp_path / "layers"))
    return catalog.create_bronze_table(spark, layer, path), tmp_path / name


def test_external_table_has_its_partitions(spark, tmp_path):
    name, _ = make_table(spark, tmp_path, "ext", bronze(spark))
    table = read_table(spark, name)
    assert table.count() == 50 and table.columns == BRONZE_SCHEMA.names
    assert table.filter("ingestion_date = '2024-01-02'").count() == 17


def test_delete_from_a_table_touches_only_its_partitions(spark, tmp_path):
    name, path = make_table(spark, tmp_path, "del", bronze(spark))
    untouched = {p: p.stat().st_mtime_ns for p in path.glob("ingestion_date=2024-01-03/*.parquet")}
    condition = "ingestion_date = '2024-01-01' or (ingestion_date = '2024-01-02' and id < 10)"
    expected = sorted(tuple(r) for r in mutations.without(spark.table(name), condition).collect())
    assert tuple(mutations.delete_from_table(spark, name, condition).first()) == (50, 20, 30)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == expected
    assert untouched == {p: p.stat().st_mtime_ns for p in path.glob("ingestion_date=2024-01-03/*.parquet")}
    assert tuple(mutations.delete_from_table(spark, name, condition).first()) == (30, 0, 30)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert spark.table(name).count() == 30
    assert tuple(mutations.delete_from_table(spark, name).first()) == (30, 30, 0)
    assert tuple(mutations.delete_from_table(spark, name).first()) == (0, 0, 0)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_delete_with_a_null_partition(spark, tmp_path):
    df = bronze(spark).withColumn("ingestion_date", F.when(F.col("id") >= 10, F.col("ingestion_date")))
    name, _ = make_table(spark, tmp_path, "nul", df)
    assert spark.table(name).filter("ingestion_date is null").count() == 10
    assert tuple(mutations.delete_from_table(spark, name, "id in (3, 20)").first()) == (50, 2, 48)
    assert spark.table(name).filter("ingestion_date is null").count() == 9
    assert tuple(mutations.delete_from_table(spark, name, "id < 10").first()) == (48, 9, 39)


def test_delete_from_a_table_without_partitions(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS plain")
    spark.sql(f"CREATE TABLE plain.t (id INT, v STRING) USING parquet LOCATION '{tmp_path}/t'")
    spark.sql("INSERT INTO plain.t VALUES (1, 'a'), (2, NULL), (3, 'c')")
    assert tuple(mutations.delete_from_table(spark, "plain.t", "v = 'a'").first()) == (3, 1, 2)
    assert sorted(r.id for r in spark.table("plain.t").collect()) == [2, 3]
    assert tuple(mutations.delete_from_table(spark, "plain.t").first()) == (2, 2, 0)


def test_delete_supports_one_partition_column(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS plain")
    spark.sql(
        f"CREATE TABLE plain.p (id INT, a INT, b INT) USING parquet PARTITIONED BY (a, b) LOCATION '{tmp_path}/p'"
    )
    with pytest.raises(ValueError, match="partition columns"):
        mutations.delete_from_table(spark, "plain.p")


def test_silver_keeps_the_latest_complete_row_per_id(spark):
    rows = [
        (1, 10, "a", 100, 0, 1),
        (1, 11, "a", 200, 0, 2),
        (1, 12, "a", 200, 0, 3),
        (1, 13, None, 900, 0, 4),
        (2, 20, "b", 100, 0, 5),
        (None, 30, "b", 100, 0, 6),
        (3, None, "b", 100, 0, 7),
    ]
    df = spark.createDataFrame(
        rows, "id int, value int, type string, timestamp long, kafka_partition int, kafka_offset long"
    ).withColumn("ingestion_date", F.lit(DAY))
    silver = layers.silver_events(df)
    assert "ingestion_date" not in silver.columns and dict(silver.dtypes)["processed_at"] == "timestamp"
    assert sorted((r.id, r.value) for r in silver.collect()) == [(1, 12), (2, 20)]


def test_repeated_delivery_and_missing_metadata(spark):
    rows = [(1, 5, "a", 100, i) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, value int, type string, timestamp long, seen int")
    assert [tuple(r) for r in layers.latest_by_id(df).collect()] == [(1, 5, "a", 100, 2)]


def test_gold(spark):
    day = 86_400_000
    silver = spark.createDataFrame(
        [(1, 10, "a", 0), (2, 20, "a", day), (3, 30, "b", day - 1)], "id int, value int, type string, timestamp long"
    )
    gold = {r.event_type: r for r in layers.gold_metrics(silver).collect()}
    assert tuple(gold["a"])[:5] == ("a", 2, 15.0, 10, 20) and gold["a"].calculated_at
    by_day = {(r.event_type, str(r.event_date)): r.total_events for r in layers.gold_by_type_and_date(silver).collect()}
    assert by_day == {("a", "1970-01-01"): 1, ("a", "1970-01-02"): 1, ("b", "1970-01-01"): 1}
    silver.createOrReplaceTempView("silver_test")
    per_type, per_day = layers.create_gold_views(spark, "silver_test")
    assert spark.table(per_type).count() == 2 and spark.table(per_day).count() == 3


def test_layers_views_and_inventory(spark, tmp_path):
    write_by_date(bronze(spark), str(tmp_path / "x"))
    listed = fill_layers(spark, str(tmp_path / "x"), str(tmp_path / "layers"), "lay_")
    assert [r.table_name for r in listed.collect()][::5] == ["events_raw", "events_cleaned"]
    assert all(r.created_at for r in listed.collect())
    fill_layers(spark, str(tmp_path / "x"), str(tmp_path / "layers"), "lay_")
    assert spark.table("lay_silver.events_cleaned").count() == 50
    assert spark.table("lay_gold.events_metrics").first().total_events == 50
    assert spark.table("lay_gold.events_by_type").first().avg_value == 245
    kinds = {r.table_name: r.table_type for r in catalog.table_inventory(spark, ["lay_gold"]).collect()}
    assert kinds == {
        "events_metrics": "MANAGED",
        "events_metrics_by_date": "MANAGED",
        "events_by_type": "VIEW",
        "events_by_type_and_date": "VIEW",
    }


def test_declared_tables(spark, tmp_path):
    (_, silver, gold) = catalog.create_layers(spark, "decl_", str(tmp_path))
    assert spark.table(catalog.create_silver_table(spark, silver)).columns[-1] == "processed_at"
    assert dict(spark.table(catalog.create_gold_table(spark, gold)).dtypes)["max_value"] == "int"
    assert "spark_catalog" in [r[0] for r in catalog.catalogs(spark).collect()]
    assert {"decl_bronze", "decl_silver", "decl_gold"} <= {r[0] for r in catalog.schemas(spark).collect()}
    comment = spark.sql("DESCRIBE SCHEMA decl_gold").filter("info_name = 'Comment'").first().info_value
    assert "gold" in comment


@pytest.mark.parametrize(
    "columns, result, missing, new",
    [
        (["id", "value", "type", "timestamp", "ingested_at"], "PASSED", [], []),
        (["id", "value", "type", "timestamp", "ingested_at", "ingestion_date"], "PASSED", [], []),
        (["id", "value", "type", "timestamp"], "INCOMPLETE", ["ingested_at"], []),
        (["id", "value", "type", "timestamp", "ingested_at", "x"], "EVOLVED", [], ["x"]),
        (["id", "x", "y"], "EVOLVED", ["ingested_at", "timestamp", "type", "value"], ["x", "y"]),
    ],
)
def test_schema_evolution(spark, columns, result, missing, new):
    df = spark.createDataFrame([tuple(range(len(columns)))], columns)
    assert tuple(lake_validation.schema_evolution(df).first()) == (result, missing, new)


def test_validation_report(spark):
    report = [tuple(r) for r in lake_validation.validation_report(bronze(spark)).collect()]
    new = ("schema_evolution", "EVOLVED", "WARN", 2, "new: kafka_offset, kafka_partition", 50, 8, 3)
    assert report == [("quality_checks", "PASSED", "PASS", 0, "", 50, 8, 3), new]
    flawed = bronze(spark).withColumn("type", F.when(F.col("id") > 4, F.col("type")))
    report = [tuple(r) for r in lake_validation.validation_report(flawed).collect()]
    assert report == [("quality_checks", "FAILED", "FAIL", 5, "nulls: FAIL: type(5)", 50, 8, 3), new]
    fewer = bronze(spark).select("id", "value", "ingested_at").unionAll(bronze(spark, 2).select("id", "value", "ingested_at"))
    (quality, evolution) = lake_validation.validation_report(fewer.select("id", "value", "ingested_at")).collect()
    assert evolution.result == "INCOMPLETE" and evolution.detail == "missing: timestamp, type" and evolution.dates is None
    assert (quality.violations, quality.total_rows) == (2, 52) and "duplicates: WARN: 2 duplicates" in quality.detail
    every = spark.createDataFrame([(r,) for r in [*lake_validation.REPORT_STATUS, "?"]], "r string")
    found = [r[0] for r in every.select(lake_validation.verdict_status(F.col("r"))).collect()]
    assert found == ["PASS", "WARN", "WARN", "FAIL", "SKIP", "UNKNOWN"]


def test_lake_checks_do_not_fail_on_violations(spark):
    flawed = bronze(spark).withColumn("id", F.lit(None).cast("int")).drop("ingestion_date")
    checks = lake_validation.lake_checks(flawed)
    assert {r.check: r.status for r in checks.results.collect()} == {"nulls": "FAIL", "duplicates": "WARN"}
    assert checks.dates is None and checks.stats.first().total_rows == 50
    with pytest.raises(AnalysisException):
        lake_validation.lake_checks(read_path(spark, "/nonexistent"))


def test_shared_folder(spark):
    first, second = workspace.new_path(spark, "a"), workspace.new_path(spark, "a")
    assert first != second and first.startswith(workspace.shared_root(spark))


def test_an_export_runs_one_job_for_its_rows(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("export", "export")
    write_by_date(bronze(spark), str(tmp_path / "x"), rebalance=False)
    jobs = tracker.getJobIdsForGroup("export")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_columns_that_appear_or_disappear_are_kept(spark, tmp_path):
    export, layers_at = str(tmp_path / "export"), str(tmp_path / "layers")
    write_by_date(bronze(spark, 10), export)
    fill_layers(spark, export, layers_at, "grow_")
    later = bronze(spark, 20).where("id >= 10").withColumn("note", F.lit("new")).drop("kafka_partition")
    later.write.mode("append").partitionBy("ingestion_date").parquet(export)
    fill_layers(spark, export, layers_at, "grow_")
    silver = {r.id: r for r in spark.table("grow_silver.events_cleaned").collect()}
    assert [silver[i].note for i in (0, 9, 10, 19)] == [None, None, "new", "new"]
    assert silver[0].kafka_partition == 0 and silver[19].kafka_partition is None
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA grow_{layer} CASCADE")


def test_delete_in_place_keeps_the_partitions(spark, tmp_path):
    path = str(tmp_path / "x")
    write_by_date(bronze(spark), path)
    where, counts = mutations.delete_from_path(spark, path, "id < 10")
    assert where == path and counts.first().remaining_rows == 40
    assert read_path(spark, path).where("id < 10").count() == 0
    assert len(list(Path(path).glob("ingestion_date=*"))) == 3 and sorted(p.name for p in tmp_path.iterdir()) == ["x", "x-schema"]


def test_silver_keeps_columns_without_an_order(spark):
    mapped = bronze(spark, 4).unionAll(bronze(spark, 4)).withColumn("tags", F.create_map(F.lit("a"), F.col("id")))
    assert layers.silver_events(mapped).count() == 4


def test_absurd_times_have_no_day(spark):
    odd = bronze(spark, 3).withColumn("timestamp", F.lit(9223372036854775807))
    assert [r.event_date for r in layers.gold_by_type_and_date(odd).collect()] == [None]
    odd.createOrReplaceTempView("odd_silver")
    _, per_day = layers.create_gold_views(spark, "odd_silver")
    assert [r.event_date for r in spark.table(per_day).collect()] == [None]


class Bare:
    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"


def test_a_shared_folder_must_be_named():
    for use in (workspace.shared_root, workspace.use_local_root):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            use(Bare)


def test_working_tables_go(spark):
    scratch = workspace.Scratch(spark, "trial")
    first, second = (scratch.settle(spark.range(n)) for n in (3, 0))
    assert (first.count(), second.count(), second.columns) == (3, 0, ["id"])
    scratch.drop(first)
    assert [p.name for p in Path(scratch.path).iterdir()] == ["002-table"]
    scratch.close()
    assert not Path(scratch.path).exists()


def _jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("external", [False, True])
def test_delete_of_many_partitions_at_once(spark, tmp_path, external, monkeypatch):
    monkeypatch.setattr(mutations, "PARTITIONS_AT_ONCE", 16)
    names = ["a b", "50%", "it's", "x/y", "c:d", "é", "a=b", "k%20l"] + [f"d{i:03}" for i in range(52)]
    rows = [(i, v) for v in names for i in range(3)] + [(i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, part string")
    jobs = []
    for k, gone in enumerate((names[:2], [*names[:50], None])):
        name, at = f"many{external}{k}".lower(), str(tmp_path / f"many{k}")
        writer = df.repartition(1).write.partitionBy("part")
        (writer.option("path", at) if external else writer).saveAsTable(name)
        listed = ", ".join("'" + v.replace("'", "\\'") + "'" for v in gone if v is not None)
        null = " OR part IS NULL" if None in gone else ""
        condition = f"part IN ({listed}){null} OR (part = 'd051' AND id = 1)"
        n = 3 * len(gone) + 1
        jobs.append(_jobs_of(spark, lambda: mutations.delete_from_table(spark, name, condition)))
        left = {(r.id, r.part) for r in spark.table(name).collect()}
        assert left == {r for r in rows if r[1] not in gone and r != (1, "d051")} and len(left) == len(rows) - n
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == len(names) + 1 - len(gone)
        if external:
            # No file is left behind that a repair of the catalog would bring back.
            assert spark.read.parquet(at).count() == len(left)
        assert tuple(mutations.delete_from_table(spark, name, condition).first()) == (len(left), 0, len(left))
        spark.sql(f"DROP TABLE {name}")
    assert jobs[1] <= jobs[0] + 2, jobs


def test_delete_reads_the_partitions_it_touches(spark, tmp_path):
    spark.range(400).selectExpr("id", "id % 40 AS part").write.partitionBy("part").saveAsTable("pruned_delete")
    touched = spark.createDataFrame([(3, 1)], "value long, gone long")
    touched.write.parquet(str(tmp_path / "touched"))
    rows = mutations._rows_of(spark.table("pruned_delete"), spark.read.parquet(str(tmp_path / "touched")), "part")
    assert "dynamicpruning" in rows._jdf.queryExecution().toString() and rows.count() == 10
    spark.sql("DROP TABLE pruned_delete")


@pytest.mark.parametrize("lost_at", ["written", "first", "second", "removed"])
def test_a_lost_delete_is_undone_or_finished(spark, tmp_path, monkeypatch, lost_at):
    path = str(tmp_path / "lost")
    spark.range(20).write.parquet(path)
    steps = {"written": ("move", 0), "first": ("move", 1), "second": ("remove", 0), "removed": ("remove", 1)}
    step, after = steps[lost_at]
    calls, real = [], getattr(mutations, step)

    def failing(*arguments):
        calls.append(arguments)
        if len(calls) > after:
            raise SystemError("lost")
        real(*arguments)

    with monkeypatch.context() as patched:
        patched.setattr(mutations, step, failing)
        with pytest.raises(SystemError):
            mutations.delete_from_path(spark, path, "id < 5")
    assert mutations.recover_path(spark, path)
    assert not mutations.recover_path(spark, path)
    left = sorted(r.id for r in spark.read.parquet(path).collect())
    assert left == ([*range(20)] if lost_at == "written" else [*range(5, 20)])
    assert tuple(mutations.delete_from_path(spark, path, "id < 5")[1].first())[2] == 15
    assert [p.name for p in tmp_path.iterdir()] == ["lost"]


def test_a_lost_delete_is_not_mistaken_for_a_new_dataset(spark, tmp_path):
    path = str(tmp_path / "anew")
    spark.range(3).write.parquet(path)
    assert mutations.write_new(spark, f"{path}-delete", f"{path}-1")
    for name in ("-1-old", "-1-new"):
        spark.range(5).write.parquet(path + name)
    with pytest.raises(OSError, match="written anew"):
        mutations.delete_from_path(spark, path, "id = 1")
    assert spark.read.parquet(f"{path}-1-old").count() == 5
