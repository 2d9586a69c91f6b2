"""Look over an exported dataset: checks, profile, schema drift and a short report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.operators.profile import dataset_stats, numeric_profile, rows_per_date
from siftlake.operators.quality import QualitySuite, run_checks, settled
from siftlake.schemas import CRITICAL_COLUMNS, EVOLUTION_COLUMNS, PARTITION_COLUMN

# How a verdict reads in the report.
REPORT_STATUS = {
    "PASSED": "PASS",
    "EVOLVED": "WARN",
    "INCOMPLETE": "WARN",
    "FAILED": "FAIL",
    "NOT_RUN": "SKIP",
}


@dataclass(frozen=True)
class LakeChecks:
    """Null and duplicate results, numeric profile, rows of the first dates (None without dates) and statistics."""

    results: DataFrame
    profile: DataFrame
    dates: DataFrame | None
    stats: DataFrame


def lake_checks(df: DataFrame) -> LakeChecks:
    """All parts computed once. Violations are reported, not raised; an error in Spark is raised."""
    suite = QualitySuite(critical_columns=CRITICAL_COLUMNS)
    return LakeChecks(
        results=settled(run_checks(df, suite, only=["nulls", "duplicates"])),
        profile=settled(numeric_profile(df)),
        dates=settled(rows_per_date(df)) if PARTITION_COLUMN in df.columns else None,
        stats=settled(dataset_stats(df)),
    )


def schema_evolution(df: DataFrame, expected: Iterable[str] = EVOLUTION_COLUMNS) -> DataFrame:
    """``result, missing, new`` in one row, from the schema alone; the partition column does not count.

    New columns read as EVOLVED even when others are missing; both lists are in the row.
    """
    actual, wanted = set(df.columns) - {PARTITION_COLUMN}, set(expected)
    missing, new = sorted(wanted - actual), sorted(actual - wanted)
    result = "EVOLVED" if new else "INCOMPLETE" if missing else "PASSED"
    return df.sparkSession.createDataFrame(
        [(result, missing, new)], "result string, missing array<string>, new array<string>"
    )


def quality_verdict(results: DataFrame) -> DataFrame:
    """``check, result, violations, detail`` in one row: FAILED if a check failed or could not be evaluated, PASSED otherwise;
    what was found is counted and told in either case."""
    bad = F.col("status").isin("FAIL", "ERROR")
    told = F.when(F.col("violations") > 0, F.concat_ws(": ", "check", "status", "detail"))
    return results.agg(
        F.lit("quality_checks").alias("check"),
        F.when(F.bool_or(bad), "FAILED").otherwise("PASSED").alias("result"),
        F.coalesce(F.sum("violations"), F.lit(0)).cast("long").alias("violations"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", told.alias("told")))), lambda r: r["told"]), "; ").alias("detail"),
    )


def evolution_verdict(evolution: DataFrame) -> DataFrame:
    """The same of a schema: its missing and new columns are counted and named."""
    named = [F.when(F.size(c) > 0, F.concat(F.lit(f"{c}: "), F.array_join(c, ", "))) for c in ("missing", "new")]
    return evolution.select(
        F.lit("schema_evolution").alias("check"),
        "result",
        (F.size("missing") + F.size("new")).cast("long").alias("violations"),
        F.concat_ws("; ", *named).alias("detail"),
    )


def verdict_status(result: Column) -> Column:
    return reduce(
        lambda found, pair: found.when(result == pair[0], pair[1]), REPORT_STATUS.items(), F.when(F.lit(False), "")
    ).otherwise("UNKNOWN")


def report_of(checks: LakeChecks, evolution: DataFrame) -> DataFrame:
    """``check, result, status, violations, detail, total_rows, schema_columns, dates`` from what was measured; ``dates`` is the
    number of first dates listed, none without a date column."""
    verdicts = quality_verdict(checks.results).unionByName(evolution_verdict(evolution))
    stats = checks.stats.first()
    dates = None if checks.dates is None else checks.dates.count()
    return verdicts.select(
        "check",
        "result",
        verdict_status(F.col("result")).alias("status"),
        "violations",
        "detail",
        F.lit(stats["total_rows"]).cast("long").alias("total_rows"),
        F.lit(stats["schema_columns"]).cast("int").alias("schema_columns"),
        F.lit(dates).cast("long").alias("dates"),
    )


def validation_report(df: DataFrame) -> DataFrame:
    """Run everything on a dataset and report what was found."""
    return report_of(lake_checks(df), schema_evolution(df))
