import pytest
from pyspark.sql import functions as F

from siftlake.functions.columns import with_partition_date
from siftlake.operators import quality
from siftlake.operators.quality import (
    CHECKS,
    QualitySuite,
    can_upload,
    failures,
    findings,
    report,
    run_checks,
    settled,
)
from siftlake.plans.export import event_suite
from siftlake.sources.generated import generate_events


def check(df, name, **options):
    row = run_checks(df, QualitySuite(**options), only=[name]).first()
    return row.status, row.detail, row.deduction


def events(spark, n=50):
    return generate_events(spark, n).select(
        F.col("id").cast("int"),
        F.col("value").cast("int"),
        "type",
        "timestamp",
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        F.lit("2024-05-01 10:00:00").cast("timestamp").alias("ingested_at"),
    )


def test_golden_events_pass_everything(spark):
    df = with_partition_date(events(spark))
    results = settled(run_checks(df, event_suite(df)))
    rows = results.orderBy("position").collect()
    assert [r.check for r in rows] == list(CHECKS)
    assert [r.status for r in rows] == ["PASS"] * 10
    assert tuple(report(results).first()) == (10, 0, 0, 100, True)
    assert can_upload(results)


def test_golden_events_without_a_date_skip_distribution(spark):
    df = events(spark)
    results = run_checks(df, event_suite(df))
    assert results.filter("status <> 'PASS'").select("check", "status").collect() == [("distribution", "SKIP")]
    assert tuple(report(results).first()) == (9, 0, 0, 100, True)


def test_row_count(spark):
    assert check(spark.range(3), "row_count") == ("PASS", "3 rows", 0)
    assert check(spark.range(0), "row_count") == ("FAIL", "0 rows", 30)
    assert check(spark.range(3), "row_count", min_rows=4) == ("FAIL", "3 rows", 30)


def test_schema(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert check(df, "schema") == ("PASS", "2 columns", 0)
    assert check(df, "schema", expected_columns={"a"}) == ("PASS", "2 columns", 0)
    assert check(df, "schema", expected_columns={"a", "z", "c"}) == ("INCOMPLETE", "missing c, z", 25)


def test_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, 2), (None, 1, 3)], "a int, b int, c int")
    assert check(df, "nulls") == ("SKIP", "no critical cols", 0)
    assert check(df, "nulls", critical_columns=["a", "b", "gone"]) == ("FAIL", "a(2), b(2)", 20)
    assert check(df.filter("c >= 3"), "nulls", critical_columns=["b"]) == ("PASS", "no nulls", 0)
    assert check(df.limit(0), "nulls", critical_columns=["a"]) == ("SKIP", "no rows", 0)
    assert check(df, "nulls", critical_columns=["gone"]) == ("PASS", "no nulls", 0)


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "id int, t int")
    assert check(df, "duplicates") == ("WARN", "1 duplicates", 10)
    assert check(df, "duplicates", key_columns=["id", "t"]) == ("PASS", "0 duplicates", 0)
    assert check(df.drop("id"), "duplicates") == ("SKIP", "no key cols", 0)
    assert check(df, "duplicates", key_columns=[]) == ("SKIP", "no key cols", 0)
    assert check(df, "duplicates", key_columns=["gone"])[::2] == ("ERROR", 10)
    assert check(df.limit(0), "duplicates") == ("PASS", "0 duplicates", 0)


def test_ranges(spark):
    df = spark.createDataFrame([(0, 1), (10, 1), (None, 11), (-1, 99)], "a int, b int")
    assert check(df, "ranges") == ("SKIP", "no config", 0)
    assert check(df, "ranges", numeric_ranges={"a": (0, 10)}) == ("WARN", "1 columns out of range", 10)
    assert check(df, "ranges", numeric_ranges={"a": (0, 10), "b": (0, 10)}) == ("WARN", "2 columns out of range", 20)
    assert check(df, "ranges", numeric_ranges={"a": (-1, 10), "gone": (0, 1)}) == ("PASS", "all in range", 0)
    texts = spark.createDataFrame([("5",), ("50",), ("five",), (None,)], "a string")
    assert check(texts, "ranges", numeric_ranges={"a": (0, 10)}) == ("WARN", "1 columns out of range", 10)
    arrays = df.select(F.array("a").alias("a"))
    assert check(arrays, "ranges", numeric_ranges={"a": (0, 1)})[::2] == ("ERROR", 10)


def test_data_types(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int")
    assert check(df, "data_types") == ("PASS", "all types valid", 0)
    assert check(df, "data_types", max_string_length=3) == ("PASS", "all types valid", 0)
    assert check(df, "data_types", max_string_length=2) == ("WARN", "1 type issues", 0)
    million = spark.range(1).select(F.repeat(F.lit("x"), 1_000_001).alias("t"))
    assert check(million, "data_types")[0] == "WARN"
    assert check(df.select("n"), "data_types")[0] == "PASS"


@pytest.mark.parametrize("zeros, status", [(9, "PASS"), (10, "WARN")])
def test_an_outlier_needs_eleven_rows(spark, zeros, status):
    df = spark.createDataFrame([(0.0,)] * zeros + [(1e9,)], "v double")
    assert check(df, "anomalies")[0] == status


def test_anomalies_edges(spark):
    assert check(spark.createDataFrame([("a",)], "t string"), "anomalies") == ("SKIP", "no numeric cols", 0)
    assert check(spark.createDataFrame([(5,)] * 20, "v int"), "anomalies") == ("PASS", "no outliers", 0)
    assert check(spark.createDataFrame([(5,)], "v int"), "anomalies")[0] == "PASS"
    assert check(spark.createDataFrame([], "v int"), "anomalies")[0] == "PASS"


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "float", "decimal(20,2)", "smallint"])
def test_outliers_on_both_sides_of_every_numeric_type(spark, kind):
    rows = [(i % 5,) for i in range(200)] + [(1000,), (-1000,), (None,)]
    df = spark.createDataFrame(rows, "v int").selectExpr(f"cast(v as {kind}) as v", "1 as steady")
    results = run_checks(df, QualitySuite(), only=["anomalies"])
    assert results.select("status", "detail").first() == ("WARN", "outliers in 1 cols")
    assert [tuple(r) for r in findings(results).collect()] == [("anomalies", "v", 2, 0)]


def test_nan_is_neither_an_outlier_nor_hides_one(spark):
    rows = [(float(i % 5),) for i in range(200)] + [(1000.0,), (float("nan"),)]
    results = run_checks(spark.createDataFrame(rows, "v double"), QualitySuite(), only=["anomalies"])
    assert findings(results).first().violations == 1
    infinite = spark.createDataFrame([(1.0,), (float("inf"),), (2.0,)], "v double")
    assert check(infinite, "anomalies")[0] == "WARN"


def test_distribution(spark):
    hot = spark.range(2000).select(F.when(F.col("id") < 1800, 0).otherwise(F.col("id") % 20 + 1).alias("p"))
    assert check(hot, "distribution") == ("SKIP", "no partition col", 0)
    assert check(hot, "distribution", partition_column="gone") == ("SKIP", "no partition col", 0)
    assert check(hot, "distribution", partition_column="p") == ("WARN", "data skew detected", 5)
    assert check(hot.filter("p > 0"), "distribution", partition_column="p") == ("PASS", "balanced", 0)
    assert check(hot.limit(0), "distribution", partition_column="p") == ("SKIP", "no rows", 0)


def test_encoding(spark):
    df = spark.createDataFrame([("ok", "x�"), ("�", "��")], "a string, b string")
    assert check(df, "encoding") == ("WARN", "2 cols with issues", 10)
    assert check(df.limit(0), "encoding") == ("PASS", "consistent", 0)
    assert check(df, "encoding", string_columns=["gone"]) == ("PASS", "consistent", 0)


def test_custom(spark):
    df = spark.createDataFrame([(1, "a"), (-2, None)], "v int, t string")
    assert check(df, "custom") == ("SKIP", "no rules", 0)
    assert check(df, "custom", rules={"r": F.col("v") > 5}) == ("PASS", "all rules passed", 0)
    assert check(df, "custom", rules={"r": "v < 0", "s": F.col("t").isNull()}) == ("FAIL", "2 rules failed", 20)
    asked = {"yes": lambda d: d.count() == 2, "no": lambda d: False}
    assert check(df, "custom", rules=asked) == ("FAIL", "1 rules failed", 10)
    broken = {"column": "nope > 1", "callable": lambda d: d.nope, "fine": "v > 5"}
    assert check(df, "custom", rules=broken) == ("FAIL", "2 rules failed", 0)


def test_quoted_names(spark):
    df = spark.createDataFrame([(None, "x")], "`it's a.b` int, t string")
    assert check(df, "nulls", critical_columns=["it's a.b"]) == ("FAIL", "it's a.b(1)", 10)
    assert check(df, "custom", rules={r"a\'b": "t = 'x'"}) == ("FAIL", "1 rules failed", 10)


def test_unknown_check(spark):
    with pytest.raises(ValueError):
        run_checks(spark.range(1), QualitySuite(), only=["nope"])


def scored(spark, *rows):
    return spark.createDataFrame(rows, "check string, status string, deduction int")


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("a", "WARN", 30), ("b", "PASS", 0)], (1, 1, 0, 70, True)),
        ([("a", "WARN", 35)], (0, 1, 0, 65, False)),
        ([("schema", "INCOMPLETE", 25)], (0, 0, 0, 75, True)),
        ([("a", "FAIL", 0), ("b", "SKIP", 0), ("c", "ERROR", 5)], (0, 0, 1, 95, False)),
        ([("a", "FAIL", 80), ("b", "FAIL", 80)], (0, 0, 2, 0, False)),
        ([], (0, 0, 0, 100, True)),
    ],
)
def test_report_and_gate(spark, rows, expected):
    assert tuple(report(scored(spark, *rows)).first()) == expected


def test_failures(spark):
    rows = [(s, s, 0) for s in ("PASS", "WARN", "FAIL", "SKIP", "ERROR", "INCOMPLETE")]
    assert {r.status for r in failures(scored(spark, *rows)).collect()} == {"FAIL", "ERROR", "INCOMPLETE"}


def test_event_suite_rules_hold_without_their_columns(spark):
    df = spark.range(5)
    assert run_checks(df, event_suite(df), only=["custom"]).first().status == "PASS"


def test_event_suite_catches_types_and_negatives(spark):
    df = events(spark).withColumn("type", F.when(F.col("id") > 0, F.col("type"))).withColumn("value", -F.col("value"))
    rows = {r.check: r for r in run_checks(df, event_suite(df)).collect()}
    assert (rows["custom"].status, rows["custom"].detail, rows["custom"].violations) == ("FAIL", "2 rules failed", 50)
    assert (rows["nulls"].status, rows["nulls"].detail) == ("FAIL", "type(1)")
    assert rows["ranges"].violations == 49


def test_deductions_can_be_configured(spark):
    from siftlake.operators.quality import DEDUCTIONS

    rows = [(i % 5,) for i in range(200)] + [(1000,)]
    df = spark.createDataFrame(rows, "v int")
    assert check(df, "anomalies", deductions=DEDUCTIONS | {"anomalies": 10}) == ("WARN", "outliers in 1 cols", 10)


def test_settled_results_need_no_more_jobs(spark):
    results = settled(run_checks(events(spark), QualitySuite(critical_columns=["id"])))
    assert "LocalTableScan" in results._jdf.queryExecution().executedPlan().toString()
    assert results.count() == 10


def test_tables_of_many_columns(spark):
    width = 60
    df = spark.range(200).select(
        *[F.when(F.col("id") != i, F.col("id") % 7).alias(f"n{i}") for i in range(width)],
        *[F.lit("x" if i else "\ufffd").alias(f"s{i}") for i in range(width)],
    )
    suite = QualitySuite(
        critical_columns=[f"n{i}" for i in range(width)], numeric_ranges={f"n{i}": (0, 5) for i in range(width)}
    )
    rows = {r.check: r for r in run_checks(df, suite).collect()}
    assert rows["nulls"].violations == width and rows["nulls"].deduction == 10 * width
    assert len(rows["anomalies"].findings) == width and rows["anomalies"].status == "PASS"
    assert (rows["ranges"].detail, rows["encoding"].detail) == ("60 columns out of range", "1 cols with issues")
    assert rows["row_count"].detail == "200 rows"
    counted = run_checks(df, suite, only=["nulls", "encoding"])
    assert counted.count() == 2


def test_bounds_beyond_the_long_range(spark):
    biggest = 2**63 - 1
    df = spark.createDataFrame([(biggest,)] * 20 + [(-biggest,)], "v bigint")
    assert check(df, "anomalies") == ("WARN", "outliers in 1 cols", 0)


def test_infinite_values_are_outliers(spark):
    values = [1.0, 2.0] * 50 + [float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    assert findings(run_checks(df, QualitySuite(), ["anomalies"])).first().violations == 2
    alone = spark.createDataFrame([(float("inf"),)], "value double")
    assert findings(run_checks(alone, QualitySuite(), ["anomalies"])).first().violations == 1


def test_a_rule_that_fails_on_the_data_fails_alone(spark):
    suite = QualitySuite(rules={"bad": "cast(type as int) < 0", "ok": "id < 0", "found": "id = 1"})
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, type string")
    results = run_checks(df, suite)
    rows = {r.check: r for r in results.collect()}
    assert len(rows) == 10 and rows["custom"].status == "FAIL" and rows["custom"].deduction == 10
    assert {r.column: r.violations for r in findings(results).where("check = 'custom'").collect()} == {
        "bad": None, "ok": 0, "found": 1
    }


def test_results_are_computed_once(spark):
    results = run_checks(spark.range(5), QualitySuite(key_columns=["id"]))
    spark.sparkContext.setJobGroup("again", "again")
    results.collect(), report(results).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("again")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "FileScan" not in results._jdf.queryExecution().toString() and len(jobs) <= 3


def test_measured_names_extra_columns_and_the_size_of_partitions(spark):
    df = spark.createDataFrame([(1, "a")] * 12 + [(2, "b")] * 3, "id int, part string")
    suite = quality.QualitySuite(expected_columns=("id", "lost"), partition_column="part")
    rows = {(r.check, r.column, r.measure): r.value for r in quality.measured(df, suite).collect()}
    assert rows == {
        ("schema", "lost", "missing"): 1, ("schema", "part", "extra"): 1, ("distribution", "part", "partitions"): 2,
        ("distribution", "part", "min_rows"): 3, ("distribution", "part", "max_rows"): 12,
        ("distribution", "part", "avg_rows"): 7.5, ("distribution", "part", "ratio"): 1.6,
    }
    empty = {r.measure: r.value for r in quality.measured(df.limit(0), suite).collect() if r.check == "distribution"}
    assert empty["partitions"] == 0 and empty["ratio"] is None
    assert quality.measured(df, quality.QualitySuite(partition_column=None)).count() == 0


def test_equal_numbers_have_no_outliers_however_they_are_spread(spark):
    df = spark.range(0, 997, 1, 13).select(F.lit(0.1).alias("x")).union(spark.range(3).where("id > 5").select(F.lit(0.1)))
    row = run_checks(df, QualitySuite(), only=["anomalies"]).first()
    assert (row.status, row.violations, row.findings) == ("PASS", 0, [])
