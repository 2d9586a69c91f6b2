"""The plans hold what the jobs promise about scans, shuffles and pruning."""

import re

from pyspark.sql import functions as F

from siftlake.operators import layers, mutations, profile, quality
from siftlake.operators.quality import CHECKS, QualitySuite
from siftlake.sinks.exports import write_by_date
from siftlake.sources.tables import read_path


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, tmp_path, rows=5000):
    df = spark.range(rows).select(
        "id",
        (F.col("id") % 100).cast("int").alias("value"),
        F.concat(F.lit("t"), F.col("id") % 5).alias("type"),
        F.col("id").alias("timestamp"),
        F.lit("x").alias("unused"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("ingestion_date"),
    )
    write_by_date(df, str(tmp_path / "t"))
    return read_path(spark, str(tmp_path / "t"))


def test_all_counting_checks_share_one_scan(spark, tmp_path):
    df = table(spark, tmp_path)
    suite = QualitySuite(
        critical_columns=["id", "value", "type"], numeric_ranges={"value": (0, 50)}, rules={"r": "value < 0"}
    )
    shared = set(CHECKS) - {"duplicates", "anomalies", "distribution"}
    text = physical(quality._run(df, suite, shared))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == text.count("Exchange SinglePartition") == 1


def test_a_whole_run_has_few_narrow_scans_and_no_join(spark, tmp_path):
    df = table(spark, tmp_path)
    suite = QualitySuite(critical_columns=["id"], key_columns=["id", "timestamp"], partition_column="ingestion_date")
    text = physical(quality._run(df, suite, set(CHECKS)))
    # The shared scan is done; no column has an outlier, so keys and partitions remain.
    assert text.count("FileScan") == 2 and "Join" not in text and "Cartesian" not in text
    keys, dates = re.findall(r"ReadSchema: (\S+)", text)
    assert keys == "struct<id:bigint,timestamp:bigint>" and dates == "struct<>"


def test_outlier_bounds_reach_the_reader(spark, tmp_path):
    df = table(spark, tmp_path).withColumn("value", F.when(F.col("id") == 7, 10**6).otherwise(F.col("value")))
    df.write.parquet(str(tmp_path / "o"))
    text = physical(quality._run(read_path(spark, str(tmp_path / "o")), QualitySuite(), {"anomalies"}))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (\S+)", text)
    assert "GreaterThan(value," in pushed[1] and "LessThan(value," in pushed[1]
    assert pushed[2] == "struct<value:int>"


def test_profile_reads_only_its_columns(spark, tmp_path):
    df = table(spark, tmp_path)
    assert "ReadSchema: struct<id:bigint,value:int,timestamp:bigint>" in physical(profile.numeric_profile(df))
    assert "ReadSchema: struct<type:string>" in physical(profile.value_frequency(df))
    assert "TakeOrderedAndProject" in physical(profile.value_frequency(df))
    assert "TakeOrderedAndProject" in physical(profile.rows_per_date(df))
    assert "ReadSchema: struct<>" in physical(profile.row_count(df))


def test_groups_are_combined_before_the_shuffle(spark, tmp_path):
    df = table(spark, tmp_path)
    for grouped in (
        layers.gold_metrics(df),
        profile.rows_per_value(df, "type"),
        profile.duplicate_count(df, ["id"]),
        profile.partition_skew(df, "type"),
    ):
        before_shuffle = physical(grouped).split("Exchange hashpartitioning")[1]
        assert "partial_count" in before_shuffle


def test_silver_keeps_one_row_per_id_before_the_shuffle(spark, tmp_path):
    df = table(spark, tmp_path).withColumns({"kafka_offset": F.col("id"), "kafka_partition": F.lit(0)})
    text = physical(layers.silver_events(df))
    before_shuffle = text.split("Exchange hashpartitioning(id")[1]
    assert "partial_max" in before_shuffle and "IsNotNull(value)" in before_shuffle
    assert text.count("Exchange") == 1 and "Window" not in text


def test_a_hot_id_reaches_the_reducer_as_one_row_per_task(spark):
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"),
        F.lit(1).alias("value"),
        F.lit("t").alias("type"),
        F.col("id").alias("timestamp"),
        F.col("id").alias("kafka_offset"),
        F.lit(0).alias("kafka_partition"),
    )
    rows = layers.silver_events(df).collect()
    assert len(rows) == 20001 and next(r.timestamp for r in rows if r.id == -1) == 29997


def test_delete_preview_prunes_partitions(spark, tmp_path):
    df = table(spark, tmp_path)
    preview = mutations.delete_preview(df, "ingestion_date = '2024-01-02' and value > 90")
    text = physical(preview)
    assert "PartitionFilters: [isnotnull(ingestion_date" in text and "GreaterThan(value,90)" in text
    expected = df.filter("ingestion_date = '2024-01-02' and value > 90").count()
    assert "Join" not in text and tuple(preview.first()) == (5000, expected)


def test_a_hot_date_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 4).select(
        "id",
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.expr("if(id % 3 > 0, date'2024-01-01', date'2024-01-02')").alias("ingestion_date"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_by_date(df, str(tmp_path / "hot"), rebalance=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(list((tmp_path / "hot" / "ingestion_date=2024-01-01").glob("*.parquet"))) > 1
    assert read_path(spark, str(tmp_path / "hot")).count() == 400_000
