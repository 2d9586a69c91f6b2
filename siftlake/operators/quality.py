"""Ten data-quality checks, their score and the gate.

A run reads the table in few narrow scans:

1. one aggregate without grouping for every check that only counts rows or measures columns; a table of many columns is
   measured in several such scans, each over columns of its own,
2. the key columns, grouped, for duplicates,
3. the partition column, grouped, for skew,
4. the numeric columns that scan 1 proved to hold outliers, filtered by their bounds (the filter reaches the
   Parquet reader, so row groups without outliers are not decoded). Without such columns there is no scan 4.

Scan 1 hands its single row to the driver because its means and deviations are the bounds of scan 4. The ten result rows
are computed when the checks are run, and kept.
"""

from __future__ import annotations

import logging
import math
import sys
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.functions import predicates as P
from siftlake.operators.profile import (
    BUFFERS_PER_SCAN,
    count_where,
    duplicate_count,
    partition_skew,
)
from siftlake.schemas import is_fractional, is_integral, literal, numeric_columns, quoted, ref, string_columns

log = logging.getLogger(__name__)

# Check names in their order, points lost on a violation (per column or rule where marked) and points
# lost when the check itself cannot be evaluated.
CHECKS = (
    "row_count",
    "schema",
    "nulls",
    "duplicates",
    "ranges",
    "data_types",
    "anomalies",
    "distribution",
    "encoding",
    "custom",
)
DEDUCTIONS = {
    "row_count": 30,
    "schema": 25,
    "nulls": 10,  # per column
    "duplicates": 10,
    "ranges": 10,  # per column
    "data_types": 0,
    "anomalies": 0,
    "distribution": 5,
    "encoding": 5,  # per column
    "custom": 10,  # per rule
}
ERROR_DEDUCTIONS = {
    "row_count": 20,
    "schema": 20,
    "nulls": 15,
    "duplicates": 10,
    "ranges": 10,
    "data_types": 5,
    "anomalies": 0,
    "distribution": 0,
    "encoding": 0,
    "custom": 0,
}
FULL_SCORE = 100
PASSING_SCORE = 70

# What a violated check reports, and how results read. %d is a number, %s a list.
VIOLATED = {
    "row_count": "FAIL",
    "schema": "INCOMPLETE",
    "nulls": "FAIL",
    "duplicates": "WARN",
    "ranges": "WARN",
    "data_types": "WARN",
    "anomalies": "WARN",
    "distribution": "WARN",
    "encoding": "WARN",
    "custom": "FAIL",
}
VIOLATED_TEXT = {
    "row_count": "%d rows",
    "schema": "missing %s",
    "nulls": "%s",
    "duplicates": "%d duplicates",
    "ranges": "%d columns out of range",
    "data_types": "%d type issues",
    "anomalies": "outliers in %d cols",
    "distribution": "data skew detected",
    "encoding": "%d cols with issues",
    "custom": "%d rules failed",
}
PASS_TEXT = {
    "row_count": "%d rows",
    "schema": "%d columns",
    "nulls": "no nulls",
    "duplicates": "%d duplicates",
    "ranges": "all in range",
    "data_types": "all types valid",
    "anomalies": "no outliers",
    "distribution": "balanced",
    "encoding": "consistent",
    "custom": "all rules passed",
}
SKIP_TEXT = {
    "nulls": "no critical cols",
    "duplicates": "no key cols",
    "ranges": "no config",
    "anomalies": "no numeric cols",
    "distribution": "no partition col",
    "custom": "no rules",
}

_NO_ROWS = "no rows"
_MIN_LONG, _MAX_LONG = -(2**63), 2**63 - 1
FINDINGS_TYPE = "array<struct<column:string,violations:bigint,deduction:int>>"
Rule = Column | str | Callable[[DataFrame], bool]


@dataclass(frozen=True)
class QualitySuite:
    """What to check. Every part is optional; a check without configuration reports SKIP.

    A rule is a violation predicate (Column or SQL text, TRUE for a bad row), counted in the shared scan. A callable
    ``DataFrame -> bool`` is accepted as well and costs the jobs it runs.
    """

    expected_columns: Iterable[str] = ()
    critical_columns: Iterable[str] = ()
    key_columns: Iterable[str] | None = None
    numeric_ranges: Mapping[str, tuple] = field(default_factory=dict)
    partition_column: str | None = None
    rules: Mapping[str, Rule] = field(default_factory=dict)
    string_columns: Iterable[str] = ()
    min_rows: int = 1
    max_string_length: int = 1_000_000
    sigma: float = 3.0
    skew_factor: float = 10.0
    deductions: Mapping[str, int] = field(default_factory=lambda: dict(DEDUCTIONS))
    error_deductions: Mapping[str, int] = field(default_factory=lambda: dict(ERROR_DEDUCTIONS))


class _Measure(NamedTuple):
    """An aggregate, the column (or rule) it looks at, and how many buffers Spark keeps for it."""

    column: str
    aggregate: Column
    buffers: int = 1


@dataclass(frozen=True)
class _Part:
    """One check: a draft result row as SQL over ``measures``, the aggregates of the frame it reads."""

    draft: str
    measures: dict[str, _Measure] = field(default_factory=dict)


def _draft(
    check: str,
    counts: Mapping[str, str],
    points: int,
    number: str = "null",
    status: str = "null",
    text: str = "null",
    listed: str = "null",
) -> str:
    """A result row before its verdict, as SQL.

    ``counts`` maps columns or rules to their violations; a NULL count marks a rule that could not be evaluated, which
    costs nothing. ``status`` and ``text`` are what data has no say in; ``number`` and ``listed`` are what %d and %s
    stand for unless it is the number and the list of bad entries.
    """
    entries = ", ".join(
        f"named_struct('column', {literal(name)}, 'violations', cast({n} as bigint), "
        f"'deduction', if(({n}) > 0, {points}, 0))"
        for name, n in counts.items()
    )
    fields = {
        "position": str(CHECKS.index(check) + 1),
        "check": literal(check),
        "fixed_status": f"cast({status} as string)",
        "fixed_text": f"cast({text} as string)",
        "bad_status": literal(VIOLATED[check]),
        "bad_text": literal(VIOLATED_TEXT[check]),
        "good_text": literal(PASS_TEXT[check]),
        "number": f"cast({number} as bigint)",
        "listed": f"cast({listed} as string)",
        "findings": f"cast(array({entries}) as {FINDINGS_TYPE})",
    }
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def _verdicts(frame: DataFrame, drafts: Iterable[str]) -> DataFrame:
    """Result rows of a one-row frame."""
    is_bad = "f -> f.violations is null or f.violations > 0"
    bad_list = "array_join(transform(bad, f -> concat(f.column, '(', f.violations, ')')), ', ')"
    return (
        frame.select(F.expr(f"inline(array({', '.join(drafts)}))"))
        .withColumn("bad", F.expr(f"filter(findings, {is_bad})"))
        .withColumn("chosen_text", F.expr("if(size(bad) > 0, bad_text, good_text)"))
        .withColumn("numbered", F.expr("replace(chosen_text, '%d', coalesce(number, size(bad)))"))
        .selectExpr(
            "position",
            "check",
            "coalesce(fixed_status, if(size(bad) > 0, bad_status, 'PASS')) as status",
            "aggregate(findings, 0L, (total, f) -> total + coalesce(f.violations, 0L)) as violations",
            f"coalesce(fixed_text, replace(numbered, '%s', coalesce(listed, {bad_list}))) as detail",
            "aggregate(findings, 0, (total, f) -> total + f.deduction) as deduction",
            "findings",
        )
    )


def _skip(check: str) -> _Part:
    return _Part(_draft(check, {}, 0, status="'SKIP'", text=literal(SKIP_TEXT[check])))


def _error(check: str, suite: QualitySuite) -> _Part:
    lost = suite.error_deductions[check]
    return _Part(_draft(check, {check: "1"}, lost, status="'ERROR'", text="'not evaluable'"))


# --- checks of the shared scan ------------------------------------------------------------------------------------


def _row_count(df: DataFrame, suite: QualitySuite) -> _Part:
    too_few = f"if(rows < {suite.min_rows}, 1, 0)"
    return _Part(_draft("row_count", {"*": too_few}, suite.deductions["row_count"], number="rows"))


def _schema(df: DataFrame, suite: QualitySuite) -> _Part:
    missing = sorted(set(suite.expected_columns) - set(df.columns))
    names = ", ".join(missing)
    counts = {names: str(len(missing))} if missing else {}
    number = str(len(df.columns))
    return _Part(_draft("schema", counts, suite.deductions["schema"], number=number, listed=literal(names)))


def _per_column(check: str, suite: QualitySuite, violations: Mapping[str, Column], **fixed: str) -> _Part:
    measures = {f"{check}_{i}": _Measure(c, count_where(v)) for i, (c, v) in enumerate(violations.items())}
    return _Part(_draft(check, dict(zip(violations, measures)), suite.deductions[check], **fixed), measures)


def _nulls(df: DataFrame, suite: QualitySuite) -> _Part:
    if not suite.critical_columns:
        return _skip("nulls")
    missing = {c: P.is_missing(c) for c in suite.critical_columns if c in df.columns}
    return _per_column("nulls", suite, missing, **_skipped_if("rows = 0"))


def _skipped_if(nothing: str) -> dict[str, str]:
    return {"status": f"if({nothing}, 'SKIP', null)", "text": f"if({nothing}, {literal(_NO_ROWS)}, null)"}


def _ranges(df: DataFrame, suite: QualitySuite) -> _Part:
    if not suite.numeric_ranges:
        return _skip("ranges")
    limits = {c: limits for c, limits in suite.numeric_ranges.items() if c in df.columns}
    texts = set(string_columns(df))
    # Text that is no number is no violation, and must not fail the scan either.
    values = {c: ref(c).try_cast("double") if c in texts else ref(c) for c in limits}
    return _per_column("ranges", suite, {c: P.outside(values[c], low, high) for c, (low, high) in limits.items()})


def _data_types(df: DataFrame, suite: QualitySuite) -> _Part:
    limit = suite.max_string_length
    # A text has at least as many bytes as characters, and its bytes need no counting.
    oversize = {
        c: (F.octet_length(ref(c)) > limit) & (F.length(ref(c)) > limit) for c in string_columns(df)
    }
    return _per_column("data_types", suite, oversize)


def _encoding(df: DataFrame, suite: QualitySuite) -> _Part:
    names = tuple(suite.string_columns) or string_columns(df)
    return _per_column("encoding", suite, {c: P.has_bad_characters(c) for c in names if c in df.columns})


def _custom(df: DataFrame, suite: QualitySuite, broken: frozenset[str] = frozenset()) -> _Part:
    """``broken``: rules that fail on the data."""
    if not suite.rules:
        return _skip("custom")
    measures: dict[str, _Measure] = {}
    counts: dict[str, str] = {}
    for i, (name, rule) in enumerate(suite.rules.items()):
        counts[name] = "cast(null as bigint)"
        if callable(rule) and not isinstance(rule, Column):
            try:
                counts[name] = "0" if rule(df) else "1"
            except Exception as problem:  # a rule that raises has failed
                log.warning("rule %s raised: %s", name, problem)
            continue
        measure = _Measure(name, count_where(F.expr(rule) if isinstance(rule, str) else rule))
        if name not in broken and _evaluable(df, [measure]):
            measures[f"custom_{i}"] = measure
            counts[name] = f"custom_{i}"
    return _Part(_draft("custom", counts, suite.deductions["custom"]), measures)


_SHARED = {
    "row_count": _row_count,
    "schema": _schema,
    "nulls": _nulls,
    "ranges": _ranges,
    "data_types": _data_types,
    "encoding": _encoding,
    "custom": _custom,
}


# --- checks with a scan of their own --------------------------------------------------------------------------------


def _duplicates(df: DataFrame, suite: QualitySuite) -> DataFrame | _Part:
    keys = suite.key_columns
    if keys is None:
        keys = ["id"] if "id" in df.columns else []
    if not keys:
        return _skip("duplicates")
    counts = {", ".join(keys): "duplicates"}
    draft = _draft("duplicates", counts, suite.deductions["duplicates"], number="duplicates")
    try:
        return _verdicts(duplicate_count(df, list(keys)), [draft])
    except AnalysisException:
        return _error("duplicates", suite)


def _distribution(df: DataFrame, suite: QualitySuite) -> DataFrame | _Part:
    column = suite.partition_column
    if not column or column not in df.columns:
        return _skip("distribution")
    counts = {column: "if(skewed, 1, 0)"}
    draft = _draft("distribution", counts, suite.deductions["distribution"], **_skipped_if("partitions = 0"))
    try:
        return _verdicts(partition_skew(df, column, suite.skew_factor), [draft])
    except AnalysisException:
        return _error("distribution", suite)


@dataclass(frozen=True)
class Bounds:
    """The accepted interval of a column and the extremes that scan 1 saw."""

    low: float
    high: float
    smallest: float
    largest: float
    infinite: int = 0

    @property
    def all_inside(self) -> bool:
        return self.low <= self.smallest and self.largest <= self.high and not self.infinite


def _finite(df: DataFrame, name: str) -> str:
    """The finite values of a column, as SQL; NaN is above infinity."""
    c = quoted(name)
    return f"case when abs({c}) < double('infinity') then {c} end" if is_fractional(df, name) else c


def _spread_measures(df: DataFrame, names: list[str]) -> dict[str, _Measure]:
    measures = {}
    for i, name in enumerate(names):
        c = _finite(df, name)
        infinite = f"abs({quoted(name)}) = double('infinity')" if is_fractional(df, name) else "false"
        # Integers stay exact: doubles round beyond 2^53.
        extreme = "{}" if is_integral(df, name) else "cast({} as double)"
        measures |= {
            f"infinite_{i}": _Measure(name, F.expr(f"count_if({infinite})")),
            f"avg_{i}": _Measure(name, F.expr(f"cast(avg({c}) as double)"), 2),
            f"stddev_{i}": _Measure(name, F.expr(f"stddev_samp({c})"), 3),
            f"min_{i}": _Measure(name, F.expr(extreme.format(f"min({c})"))),
            f"max_{i}": _Measure(name, F.expr(extreme.format(f"max({c})"))),
        }
    return measures


def _bounds(row: Mapping, names: list[str], sigma: float) -> dict[str, Bounds]:
    """Mean and deviation are those of the finite values; every infinite value is an outlier. Columns without spread have
    no bounds unless they hold such a value, and then no finite value is outside."""
    found = {}
    for i, name in enumerate(names):
        mean, deviation, infinite = row[f"avg_{i}"], row[f"stddev_{i}"], row[f"infinite_{i}"]
        # Deviations of equal numbers, merged from tasks, may differ from 0 in their last digit.
        spread = deviation if row[f"min_{i}"] != row[f"max_{i}"] else 0
        if mean is None or not spread or not math.isfinite(mean) or not math.isfinite(spread):
            if infinite:
                found[name] = Bounds(-sys.float_info.max, sys.float_info.max, 0.0, 0.0, infinite)
            continue
        low, high = mean - sigma * deviation, mean + sigma * deviation
        found[name] = Bounds(low, high, row[f"min_{i}"], row[f"max_{i}"], infinite)
    return found


def is_outlier(df: DataFrame, name: str, bounds: Bounds) -> Column:
    """Strictly outside the bounds, in a form the Parquet reader can use to skip row groups."""
    c = ref(name)
    if is_integral(df, name):
        low, high = max(math.ceil(bounds.low), _MIN_LONG), min(math.floor(bounds.high), _MAX_LONG)
        return (c > F.lit(high)) | (c < F.lit(low))
    if not is_fractional(df, name):
        c = c.cast("double")
    # NaN sorts above every number, so the largest real value keeps it out.
    outside = ((c > F.lit(bounds.high)) & (c <= F.lit(bounds.largest))) | (c < F.lit(bounds.low))
    return outside | (c == F.lit(math.inf)) if bounds.infinite else outside


def _anomalies(df: DataFrame, suite: QualitySuite, names: list[str], row: Mapping) -> DataFrame | _Part:
    bounds = _bounds(row, names, suite.sigma)
    suspects = [name for name in names if name in bounds and not bounds[name].all_inside]
    outside = {name: is_outlier(df, name, bounds[name]) for name in suspects}
    counts = {name: "0" for name in bounds} | {name: f"outliers_{i}" for i, name in enumerate(suspects)}
    draft = _draft("anomalies", counts, suite.deductions["anomalies"])
    if not suspects:
        return _Part(draft)
    counted = df.filter(reduce(Column.__or__, outside.values())).agg(
        *[count_where(outside[name]).alias(f"outliers_{i}") for i, name in enumerate(suspects)]
    )
    return _verdicts(counted, [draft])


# --- running --------------------------------------------------------------------------------------------------------


def _evaluable(df: DataFrame, measures: Iterable[_Measure]) -> bool:
    """Whether Spark can resolve the aggregates on this schema; runs no job."""
    try:
        df.agg(F.lit(1).alias("one"), *[m.aggregate for m in measures])
        return True
    except AnalysisException:
        return False


def _scans(measures: dict[str, _Measure]) -> list[list[str]]:
    """The measures of each scan: those of one column together, as many columns as the buffers allow."""
    by_column: dict[str, list[str]] = {}
    for name, measure in measures.items():
        by_column.setdefault(measure.column, []).append(name)
    scans, room = [[]], BUFFERS_PER_SCAN
    for names in by_column.values():
        needed = sum(measures[name].buffers for name in names)
        if needed > room and scans[-1]:
            scans.append([])
            room = BUFFERS_PER_SCAN
        scans[-1] += names
        room -= needed
    return scans


def _side_by_side(frames: list[DataFrame]) -> DataFrame:
    """One-row frames as one row, computed at the same time."""
    columns = {}
    with ThreadPoolExecutor(len(frames)) as pool:
        rows = list(pool.map(DataFrame.toArrow, frames))
    for row in rows:
        columns |= {name: row.column(name) for name in row.column_names}
    schema = T.StructType([f for frame in frames for f in frame.schema.fields])
    return frames[0].sparkSession.createDataFrame(pa.table(columns), schema=schema)


def run_checks(df: DataFrame, suite: QualitySuite, only: Iterable[str] = CHECKS) -> DataFrame:
    """One row per check: ``position, check, status, violations, detail, deduction, findings``.

    ``only`` selects checks. The rows are computed once, when this is called, whatever the checks and the number of
    columns: looking at them again reads nothing.

    A rule that fails on the data (not for lack of storage or of the cluster) is found by measuring the rules one by one;
    it fails without costing points, and all else comes from one scan again.
    """
    only = set(only)
    unknown = only - set(CHECKS)
    if unknown:
        raise ValueError(f"no such checks: {sorted(unknown)}")

    try:
        return settled(_run(df, suite, only, frozenset()))
    except DATA_ERRORS:
        broken = _broken_rules(df, suite) if "custom" in only else frozenset()
        if not broken:
            raise
        return settled(_run(df, suite, only, broken))


# What an expression raises on the data it meets.
DATA_ERRORS = (
    ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, NumberFormatException,
    IllegalArgumentException, SparkRuntimeException,
)


def _broken_rules(df: DataFrame, suite: QualitySuite) -> frozenset[str]:
    """The rules whose count fails on the data."""
    broken = set()
    for name, measure in _custom_measures(df, suite).items():
        try:
            df.agg(measure.aggregate).collect()
        except DATA_ERRORS as problem:
            log.warning("rule %s failed on the data: %s", name, problem)
            broken.add(name)
    return frozenset(broken)


def _custom_measures(df: DataFrame, suite: QualitySuite) -> dict[str, _Measure]:
    written = {name: rule for name, rule in suite.rules.items() if isinstance(rule, (str, Column))}
    measures = {
        name: _Measure(name, count_where(F.expr(rule) if isinstance(rule, str) else rule)) for name, rule in written.items()
    }
    return {name: measure for name, measure in measures.items() if _evaluable(df, [measure])}


def _shared_parts(
    df: DataFrame, suite: QualitySuite, only: Iterable[str], broken: frozenset[str] = frozenset()
) -> tuple[dict[str, _Part], dict[str, _Measure]]:
    """The checks of the shared scan and what they measure; a check that this schema can't answer is an error of its own."""
    builders = dict(_SHARED) | {"custom": lambda df, suite: _custom(df, suite, broken)}
    parts = {check: build(df, suite) for check, build in builders.items() if check in only}
    if not _evaluable(df, [m for part in parts.values() for m in part.measures.values()]):
        parts = {
            check: part if _evaluable(df, part.measures.values()) else _error(check, suite)
            for check, part in parts.items()
        }
    measures = {"rows": _Measure("*", F.count(F.lit(1)))}
    for part in parts.values():
        measures |= part.measures
    return parts, measures


def _run(df: DataFrame, suite: QualitySuite, only: set[str], broken: frozenset[str] = frozenset()) -> DataFrame:
    """The checks as one plan, with the shared scan computed where later ones need its numbers."""
    parts, measures = _shared_parts(df, suite, only, broken)
    numeric = numeric_columns(df) if "anomalies" in only else []
    measures |= _spread_measures(df, numeric)
    scans = [df.agg(*[measures[n].aggregate.alias(n) for n in names]) for names in _scans(measures)]
    # Settled with the rest unless its numbers are needed now, or it comes in several frames.
    shared = _side_by_side(scans) if numeric or len(scans) > 1 else scans[0]

    own: list[DataFrame | _Part] = []
    if numeric:
        own.append(_anomalies(df, suite, numeric, shared.first().asDict()))
    elif "anomalies" in only:
        own.append(_skip("anomalies"))
    if "duplicates" in only:
        own.append(_duplicates(df, suite))
    if "distribution" in only:
        own.append(_distribution(df, suite))

    drafts = [p.draft for p in [*parts.values(), *own] if isinstance(p, _Part)]
    frames = [f for f in own if isinstance(f, DataFrame)]
    if drafts:
        frames.insert(0, _verdicts(shared, drafts))
    return reduce(DataFrame.unionByName, frames)


def settled(results: DataFrame) -> DataFrame:
    """The same result rows, computed once. For frames of bounded size only: results, reports, profiles."""
    return results.sparkSession.createDataFrame(results.toArrow(), schema=results.schema)


def findings(results: DataFrame) -> DataFrame:
    """``check, column, violations, deduction`` for the checks that look at single columns or rules."""
    return results.select("check", F.inline("findings"))


def failures(results: DataFrame) -> DataFrame:
    """The results that stop a strict run, whatever the score: FAIL, INCOMPLETE and ERROR."""
    return results.filter(F.col("status").isin("FAIL", "INCOMPLETE", "ERROR"))


def report(results: DataFrame) -> DataFrame:
    """``passed, warned, failed, quality_score, can_upload`` in one row; SKIP, ERROR and INCOMPLETE count in no group."""
    counted = results.agg(
        count_where(F.col("status") == "PASS").alias("passed"),
        count_where(F.col("status") == "WARN").alias("warned"),
        count_where(F.col("status") == "FAIL").alias("failed"),
        F.greatest(F.lit(0), F.lit(FULL_SCORE) - F.coalesce(F.sum("deduction"), F.lit(0)))
        .cast("int")
        .alias("quality_score"),
    )
    return counted.withColumn(
        "can_upload", (F.col("quality_score") >= PASSING_SCORE) & (F.col("failed") == 0)
    )


def can_upload(results: DataFrame) -> bool:
    """The gate: a score of at least 70 and no FAIL."""
    return report(results).first()["can_upload"]


def measured(df: DataFrame, suite: QualitySuite) -> DataFrame:
    """``check, column, measure, value``: what the verdicts of schema and distribution do not say.

    Every column that is missing, and every one that is there but not expected (none when the suite expects nothing); rows
    in the smallest, the largest and the average partition, and the largest as a multiple of the average. An empty dataset
    has 0 partitions and NULL for the rest; without the partition column there are no such rows.
    """
    expected, there = set(suite.expected_columns), set(df.columns)
    named = [("schema", c, "missing", 1.0) for c in sorted(expected - there)]
    named += [("schema", c, "extra", 1.0) for c in sorted(there - expected) if expected]
    rows = df.sparkSession.createDataFrame(named, "check string, column string, measure string, value double")
    column = suite.partition_column
    if not column or column not in df.columns:
        return rows
    skew = partition_skew(df, column, suite.skew_factor).withColumn("ratio", F.col("max_rows") / F.col("avg_rows"))
    measures = ("partitions", "min_rows", "max_rows", "avg_rows", "ratio")
    pairs = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures))
    return rows.unionByName(skew.select(F.lit("distribution").alias("check"), F.lit(column).alias("column"), F.inline(pairs)))
