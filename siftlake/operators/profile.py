"""Profiles and counts. Everything is a partial aggregate per task before any row is shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.functions.columns import text_length
from siftlake.schemas import (
    PARTITION_COLUMN,
    is_fractional,
    literal,
    numeric_columns,
    quoted,
    ref,
    string_columns,
)
from siftlake.workspace import Scratch

# Buckets whose values ``top_values`` counts first, for each value asked for.
FULLEST_PER_VALUE = 4


def count_where(condition: Column) -> Column:
    """Rows for which the condition is TRUE."""
    return F.count(F.when(condition, F.lit(1)))


# Aggregate buffers per aggregate. Spark compiles an aggregate into one method, which the JVM stops optimising when it
# grows and Spark stops compiling beyond 100 buffers: 40 columns at once took six times as long as five columns at a
# time. Parquet keeps columns apart, so several aggregates over different columns read no more than one over all.
BUFFERS_PER_SCAN = 48
_PROFILE_BUFFERS = 8


def unpivot_row(row: DataFrame, structs: list[str]) -> DataFrame:
    """A one-row frame as one row per struct, given as SQL."""
    return row.select(F.expr(f"inline(array({', '.join(structs)}))"))


def measured(df: DataFrame, name: str) -> str:
    """A numeric column for statistics, as SQL; NaN left out: one NaN would turn mean and deviation into NaN."""
    c = quoted(name)
    return f"case when not isnan({c}) then {c} end" if is_fractional(df, name) else c


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, min, max, avg, stddev, count, nan_count, min_exact, max_exact`` for every numeric column, reading those
    columns once. The exact extremes are texts, of integral and decimal columns: doubles round beyond 2^53."""
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column string, min double, max double, avg double, stddev double, count long, nan_count long, "
            "min_exact string, max_exact string",
        )
    step = BUFFERS_PER_SCAN // _PROFILE_BUFFERS
    parts = [_profile_part(df, columns[i : i + step]) for i in range(0, len(columns), step)]
    return reduce(DataFrame.union, parts)


def _profile_part(df: DataFrame, columns: list[str]) -> DataFrame:
    measures, rows = [], []
    for i, name in enumerate(columns):
        c = measured(df, name)
        nan = f"count({quoted(name)}) - count({c})" if is_fractional(df, name) else "0L"
        values = {
            "min": f"cast(min({c}) as double)",
            "max": f"cast(max({c}) as double)",
            "avg": f"cast(avg({c}) as double)",
            "stddev": f"stddev_samp({c})",
            "count": f"count({c})",
            "nan_count": nan,
            "min_exact": "cast(null as string)" if is_fractional(df, name) else f"cast(min({c}) as string)",
            "max_exact": "cast(null as string)" if is_fractional(df, name) else f"cast(max({c}) as string)",
        }
        measures += [f"{sql} as {key}_{i}" for key, sql in values.items()]
        fields = ", ".join(f"'{key}', {key}_{i}" for key in values)
        rows.append(f"named_struct('column', {literal(name)}, {fields})")
    return unpivot_row(df.agg(*map(F.expr, measures)), rows)


def longest_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, max_length`` in characters for every string column; 0 when there is no text."""
    columns = string_columns(df) if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, max_length int")
    step = BUFFERS_PER_SCAN
    parts = [_lengths_part(df, columns[i : i + step]) for i in range(0, len(columns), step)]
    return reduce(DataFrame.union, parts)


def _lengths_part(df: DataFrame, columns: list[str]) -> DataFrame:
    measures = [F.max(text_length(c)).alias(f"max_{i}") for i, c in enumerate(columns)]
    rows = [
        f"named_struct('column', {literal(c)}, 'max_length', coalesce(max_{i}, 0))" for i, c in enumerate(columns)
    ]
    return unpivot_row(df.agg(*measures), rows)


def rows_per_value(df: DataFrame, column: str) -> DataFrame:
    """``<column>, count``. Hot values cost nothing extra: each task sends one row per value."""
    return df.groupBy(ref(column).alias(column)).count()


def value_frequency(df: DataFrame, column: str = "type", top: int = 20) -> DataFrame:
    """The most frequent values, ties by value."""
    return rows_per_value(df, column).orderBy(F.desc("count"), ref(column)).limit(top)


def top_values(df: DataFrame, column: str, top: int = 20, buckets: int = 1 << 16) -> DataFrame:
    """The same rows as ``value_frequency``, for columns with very many values, of which few cross the shuffle.

    Values are counted by a hash into ``buckets`` first: no value occurs more often than its bucket. Those of the fullest
    buckets are then counted themselves, and the last count of the best ``top`` is one that the bucket of any better value
    must reach. The values of all buckets that reach it are counted in the end. Where the bounds decide nothing (all
    values about as frequent, or fewer of them than ``top``) these are all buckets, and what is left is the plain grouping:
    the result is exact in any case, ties included. Three scans of one column.

    The list of buckets is a working table of at most ``buckets`` rows, which the two later scans are joined with.
    """
    scratch = Scratch(df.sparkSession, "top-values")
    hashed = df.select(ref(column).alias("value"), F.pmod(F.xxhash64(ref(column)), F.lit(buckets)).alias("bucket"))
    filled = scratch.settle(hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")))
    fullest = filled.orderBy(F.desc("held"), "bucket").limit(top * FULLEST_PER_VALUE)

    def counted(chosen: DataFrame) -> DataFrame:
        return hashed.join(chosen.select("bucket"), "bucket", "left_semi").groupBy("value").count()

    first = counted(fullest).orderBy(F.desc("count"), "value").limit(top)
    reached = first.agg(F.when(F.count(F.lit(1)) == top, F.min("count")).alias("least")).first().least
    enough = filled if reached is None else filled.where(F.col("held") >= reached)
    best = counted(enough).orderBy(F.desc("count"), "value").limit(top)
    best = df.sparkSession.createDataFrame(best.collect(), best.schema)
    scratch.close()
    return best.select(F.col("value").alias(column), "count")


def rows_per_date(df: DataFrame, column: str = PARTITION_COLUMN, first: int | None = 10) -> DataFrame:
    """Rows per date, ascending; the first ten unless told otherwise."""
    counts = rows_per_value(df, column).orderBy(ref(column))
    return counts if first is None else counts.limit(first)


def _key(df: DataFrame, name: str, digest: bool) -> Column:
    is_text = any(f.name == name and f.dataType == T.StringType() for f in df.schema.fields)
    return F.unhex(F.sha2(ref(name), 256)) if digest and is_text else ref(name)


def key_columns(df: DataFrame, keys: list[str], digest_keys: bool = True) -> list[Column]:
    """The columns of a key for grouping, ``key_0`` and so on; texts as digests."""
    return [_key(df, k, digest_keys).alias(f"key_{i}") for i, k in enumerate(keys)]


def duplicate_count(df: DataFrame, keys: list[str], digest_keys: bool = True) -> DataFrame:
    """``total_rows, distinct_keys, duplicates`` for a key; NULLs in a key equal each other.

    Only the key columns are read, and a key repeated within a task crosses the shuffle once. Whole documents can be keys:
    every text of a key, whatever its length, stands for its SHA-256, so that 32 bytes of it are shuffled and two texts
    are equal when their digests are. ``digest_keys=False`` compares the texts themselves.
    """
    keyed = df.select(*key_columns(df, keys, digest_keys))
    per_key = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )


def partition_skew(df: DataFrame, column: str, factor: float = 10) -> DataFrame:
    """``partitions, min_rows, max_rows, avg_rows, skewed`` over the rows per value of a column."""
    return skew_of(rows_per_value(df, column), factor)


def skew_of(counts: DataFrame, factor: float = 10) -> DataFrame:
    """The same of rows that were counted before, in ``count``."""
    return counts.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.min("count").alias("min_rows"),
        F.max("count").alias("max_rows"),
        F.avg("count").alias("avg_rows"),
        (F.max("count") > F.avg("count") * factor).alias("skewed"),
    )


def dataset_stats(df: DataFrame) -> DataFrame:
    """``total_rows, num_partitions, schema_columns``; partitions are the physical, non-empty ones."""
    per_partition = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return per_partition.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("num_partitions"),
        F.lit(len(df.columns)).alias("schema_columns"),
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as ``position, name, type, nullable``."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)],
        "position int, name string, type string, nullable boolean",
    )


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
