import math

import pytest
from pyspark.sql import functions as F

from siftlake.functions import predicates as P
from siftlake.operators import profile
from siftlake.schemas import ref


def test_numeric_profile_of_the_fifty_events(spark):
    df = spark.range(50).selectExpr("cast(id as int) as id", "cast(id * 10 as int) as value", "'t' as s")
    rows = {r.column: r for r in profile.numeric_profile(df).collect()}
    assert set(rows) == {"id", "value"}
    value = rows["value"]
    assert (value.min, value.max, value.avg, value["count"]) == (0, 490, 245, 50)
    assert value.stddev == pytest.approx(10 * math.sqrt(212.5))


def test_numeric_profile_nulls_nan_and_types(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1Y, 2S, 1.5BD, float('nan'), double(1), 'x', array(1)), "
        "(2Y, NULL, 2.5BD, float(4), double(3), 'y', array(2)) AS t(b, s, d, f, x, t, a)"
    )
    rows = {r.column: r for r in profile.numeric_profile(df).collect()}
    assert set(rows) == {"b", "s", "d", "f", "x"}
    assert (rows["f"].avg, rows["f"]["count"], rows["f"].nan_count, rows["f"].stddev) == (4, 1, 1, None)
    assert (rows["s"]["count"], rows["s"].avg) == (1, 2)
    assert (rows["d"].avg, rows["d"].min) == (2, 1.5)
    assert profile.numeric_profile(df.select("t")).count() == 0


def test_empty_frame(spark):
    df = spark.createDataFrame([], "v int, t string")
    row = profile.numeric_profile(df).first()
    assert (row.min, row.avg, row["count"], row.nan_count) == (None, None, 0, 0)
    assert profile.longest_strings(df).first().max_length == 0
    assert tuple(profile.duplicate_count(df, ["v"]).first()) == (0, 0, 0)
    assert tuple(profile.dataset_stats(df).first()) == (0, 0, 2)
    assert profile.row_count(df).first().total_rows == 0


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "ab"), (3, None)], ["a.b", "c`d"])
    assert profile.numeric_profile(df).first().max == 3
    assert tuple(profile.longest_strings(df).first()) == ("c`d", 2)
    assert profile.value_frequency(df, "c`d").count() == 2
    assert profile.duplicate_count(df, ["a.b", "c`d"]).first().duplicates == 0


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None), (1, None), (1, 2)], "a int, b int")
    assert tuple(profile.duplicate_count(df, ["a", "b"]).first()) == (5, 3, 2)


def test_duplicates_of_long_texts(spark):
    long = "x" * 300
    digest = spark.range(1).select(F.sha2(F.lit(long), 256)).first()[0]
    texts = [long, long, long + "y", digest, "s", "s", None, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert tuple(profile.duplicate_count(df, ["t"]).first()) == (8, 5, 3)


def test_value_frequency_order_and_limit(spark):
    df = spark.createDataFrame([(t,) for t in ["b", "b", "a", "a", "c", None]], "type string")
    assert [tuple(r) for r in profile.value_frequency(df).collect()][:2] == [("a", 2), ("b", 2)]
    assert profile.value_frequency(df, top=3).count() == 3
    many = spark.range(100).select(F.col("id").cast("string").alias("type"))
    assert profile.value_frequency(many).count() == 20


def test_rows_per_date(spark):
    df = spark.range(24).selectExpr("date_add(date'2024-01-01', cast(id % 12 as int)) as ingestion_date")
    rows = profile.rows_per_date(df).collect()
    assert len(rows) == 10 and rows == sorted(rows) and rows[0]["count"] == 2
    assert profile.rows_per_date(df, first=None).count() == 12


def test_partition_skew(spark):
    hot = spark.range(2000).select(F.when(F.col("id") < 1800, 0).otherwise(F.col("id") % 20 + 1).alias("p"))
    row = profile.partition_skew(hot, "p").first()
    assert (row.partitions, row.min_rows, row.max_rows, row.skewed) == (21, 10, 1800, True)
    even = spark.range(2000).select((F.col("id") % 20).alias("p"))
    assert profile.partition_skew(even, "p").first().skewed is False
    assert profile.partition_skew(spark.range(5).withColumn("p", F.lit(1)), "p").first().skewed is False


def test_stats_count_physical_partitions(spark):
    df = spark.range(0, 100, 1, 7).withColumn("x", F.lit(1))
    assert tuple(profile.dataset_stats(df).first()) == (100, 7, 2)


def test_schema_and_sample(spark):
    df = spark.range(30).withColumn("t", F.lit("x"))
    rows = [tuple(r) for r in profile.schema_rows(df).collect()]
    assert rows == [(0, "id", "bigint", False), (1, "t", "string", False)]
    assert profile.sample_rows(df).count() == 10 and profile.sample_rows(df, 3).count() == 3


def test_predicates(spark):
    df = spark.createDataFrame(
        [(0, "a"), (5, "b"), (10, "x�"), (-1, None), (11, "a"), (None, "a")], "v int, t string"
    )
    count = lambda p: df.filter(p).count()
    assert count(P.out_of_range("v", 0, 10)) == 2
    assert count(P.is_missing("v")) == 1
    assert count(P.is_negative("v")) == 1
    assert count(P.not_in_set("t", ["a", "b"])) == 2
    assert count(P.has_bad_characters("t")) == 1
    assert count(P.matches("v > 5")) == 2 and count(~P.matches("v > 5")) == 4
    assert count(P.matches(None)) == 6
    assert count(ref("t").isin("a", "b")) == 4


def test_profile_of_many_columns(spark):
    df = spark.range(10).select(
        *[(F.col("id") * i).alias(f"n{i}") for i in range(70)], *[F.lit("x" * i).alias(f"s{i}") for i in range(70)]
    )
    found = {r.column: r for r in profile.numeric_profile(df).collect()}
    assert len(found) == 70 and found["n69"].max == 621
    lengths = {r.column: r.max_length for r in profile.longest_strings(df).collect()}
    assert len(lengths) == 70 and lengths["s69"] == 69


def test_extremes_beyond_doubles_are_exact(spark):
    wide = spark.createDataFrame([(9007199254740993, 1.5), (9007199254740995, 2.5)], "id long, x double")
    rows = {r["column"]: r for r in profile.numeric_profile(wide).collect()}
    assert (rows["id"].min_exact, rows["id"].max_exact) == ("9007199254740993", "9007199254740995")
    assert rows["x"].min_exact is None


def test_one_key_form_for_texts_of_any_length(spark):
    texts = spark.createDataFrame([("a",), ("a",), ("b" * 300,), ("b" * 300,), ("c" * 300,), (None,), (None,)], "t string")
    for digest in (True, False):
        found = profile.duplicate_count(texts, ["t"], digest_keys=digest).first()
        assert tuple(found) == (7, 4, 3)


def _cases(spark):
    random = spark.range(6000).select((F.rand(3) * 4000).cast("int").alias("v"))
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).cast("int").alias("v"))
    unique = spark.range(2000).select(F.col("id").cast("int").alias("v"))
    nulls = spark.range(500).select(F.expr("if(id % 2 = 0, null, int(id % 40))").alias("v"))
    steps = spark.range(1, 121).select(F.explode(F.expr("array_repeat(int(id), int(id))")).alias("v"))
    few = spark.range(50).select((F.col("id") % 3).cast("int").alias("v"))
    return {"random": random, "hot": hot, "unique": unique, "nulls": nulls, "steps": steps, "few": few, "none": few.limit(0)}


@pytest.mark.parametrize("buckets", [1, 7, 300, 1 << 16])
def test_top_values_are_those_of_the_whole_grouping(spark, buckets):
    for name, df in _cases(spark).items():
        expected = [tuple(r) for r in profile.value_frequency(df, "v", 9).collect()]
        found = profile.top_values(df, "v", 9, buckets)
        assert [tuple(r) for r in found.collect()] == expected, name
        assert found.dtypes == profile.value_frequency(df, "v", 9).dtypes


def test_top_values_look_at_buckets_beyond_the_first_choice(spark, monkeypatch):
    """Four buckets filled by many rare values hide the one in which a frequent value is alone."""
    monkeypatch.setattr(profile, "FULLEST_PER_VALUE", 1)
    bucket = F.pmod(F.xxhash64("v"), F.lit(8))
    numbers = spark.range(40000).withColumnRenamed("id", "v").withColumn("b", bucket)
    crowd = numbers.where("b = 3").select("v")
    alone = numbers.where("b = 5").limit(1).select("v", F.explode(F.expr("sequence(1, 50)"))).select("v")
    both = crowd.unionAll(alone)
    assert [tuple(r) for r in profile.top_values(both, "v", 1, 8).collect()] == [(alone.first().v, 50)]


def test_top_values_of_odd_names_and_texts(spark):
    df = spark.createDataFrame([("x", 1), ("", 2), (None, 3), ("x", 4), ("", 5), ("", 6)], "`a.b` string, bucket int")
    assert [tuple(r) for r in profile.top_values(df, "a.b", 2).collect()] == [("", 3), ("x", 2)]
    assert profile.top_values(df, "bucket").columns == ["bucket", "count"]
