"""The ten checks of a dataset that grows by partitions, from statistics kept per partition.

What the checks count and measure is kept for every partition in a form that can be merged: counts, sums, extremes, and mean
and centred second moment of every number. A run measures partitions whose files changed, merges what is kept, and gives
the results of ``run_checks`` over the whole dataset. Two checks ask for more than such numbers:

* duplicates may lie in different partitions, so the distinct keys of each are kept too (texts as digests) and grouped
  again; the data are not read for it,
* outliers are counted by the bounds of the whole dataset, which any new row moves. Only partitions whose extremes lie beyond
  them are read for it, of all partitions the columns in question.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from siftlake.operators.profile import key_columns, skew_of
from siftlake.operators.quality import (
    DATA_ERRORS,
    QualitySuite,
    _anomalies,
    _bounds,
    _broken_rules,
    _distribution,
    _draft,
    _error,
    _finite,
    _Measure,
    _Part,
    _scans,
    _shared_parts,
    _side_by_side,
    _skip,
    _skipped_if,
    _spread_measures,
    _verdicts,
    settled,
)
from siftlake.schemas import PARTITION_COLUMN, numeric_columns, ref
from siftlake.sources.schema_log import SchemaLog
from siftlake.workspace import Scratch, children, exists

# Partitions measured at a time, and partitions that are named to the reader when outliers are looked for. Their values are
# what the driver holds of them.
PARTITIONS_PER_BATCH = 1000
_CHECKS_OF_COUNTS = ("row_count", "schema", "nulls", "ranges", "data_types", "encoding", "custom")
# Columns of the store, beside those measured.
PART, STATE, ROWS = "part", "state", "rows"


def _moments(df: DataFrame, names: list[str]) -> dict[str, _Measure]:
    """The measures of a spread in a form that can be merged: the deviation gives way to a count and a second moment."""
    measures = {n: m for n, m in _spread_measures(df, names).items() if not n.startswith("stddev_")}
    for i, name in enumerate(names):
        c = _finite(df, name)
        measures[f"n_{i}"] = _Measure(name, F.expr(f"count({c})"))
        measures[f"m2_{i}"] = _Measure(name, F.expr(f"coalesce(var_pop({c}) * count({c}), 0d)"), 3)
    return measures


def _merged_count(name: str) -> Column:
    """The sum over partitions; NULL if a rule could not be evaluated on one of them."""
    total = F.coalesce(F.sum(name), F.lit(0)).cast("long")
    return F.when(F.count(F.when(F.col(name).isNull(), 1)) == 0, total).alias(name)


def merged(kept: DataFrame) -> DataFrame:
    """One row: the measures of all partitions of ``kept`` together.

    Mean first, then second moments around it: both looks are at one row per partition, and no large numbers cancel.
    """
    spread = [name[2:] for name in kept.columns if name.startswith("n_")]
    merges = {}
    for name in kept.columns:
        kind = name.split("_")[0]
        if name in (PART, STATE) or kind == "m2":
            continue
        if kind == "avg":
            i = name[4:]
            merges[name] = (F.sum(F.col(name) * F.col(f"n_{i}")) / F.nullif(F.sum(f"n_{i}"), F.lit(0))).alias(name)
        else:
            merges[name] = {"min": F.min, "max": F.max}.get(kind, _merged_count)(name).alias(name)
    first = settled(kept.agg(*merges.values()))
    if not spread:
        return first
    means = first.first()
    second = []
    for i in spread:
        n, mean = means[f"n_{i}"], means[f"avg_{i}"]
        if n < 2:
            second.append(F.lit(None).cast("double").alias(f"stddev_{i}"))
        elif means[f"min_{i}"] == means[f"max_{i}"]:  # means of equal numbers may differ in their last digit
            second.append(F.lit(0.0).alias(f"stddev_{i}"))
        else:
            apart = F.col(f"avg_{i}") - F.lit(mean)
            moment = F.sum(F.col(f"m2_{i}") + F.coalesce(F.col(f"n_{i}") * apart * apart, F.lit(0.0)))
            second.append(F.sqrt(moment / F.lit(n - 1)).alias(f"stddev_{i}"))
    return _side_by_side([first, kept.agg(F.count(F.lit(1)).alias("partitions"), *second)])


class PartitionChecks:
    """The statistics of a Parquet dataset, kept below ``store``.

    ``partition`` is a partition column of the dataset; a NULL there is a partition like others. The columns are those of the
    dataset's schema log, or ``schema``. A folder of the store belongs to one set of columns, keys and measures: after a new
    column, rule or range all partitions are measured anew in a folder of their own, while points, ``sigma``, ``skew_factor``
    and ``min_rows`` may change freely. A rule by a UDF is known by its name only.

    A partition is as it was when number, names, sizes and times of its files are. What is kept of one becomes valid with its
    last row, so that a run lost half way goes on where it ended. One run at a time may work on a store.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        store: str,
        suite: QualitySuite,
        partition: str = PARTITION_COLUMN,
        schema: T.StructType | None = None,
    ):
        if any(callable(rule) and not isinstance(rule, Column) for rule in suite.rules.values()):
            raise ValueError("a rule that is a function of the whole dataset can't be kept per partition")
        self.spark, self.path, self.suite, self.partition = spark, path, suite, partition
        schema = schema or SchemaLog.beside(spark, path).of_dataset(path)
        # Without the partition column its type is inferred from the folders, here and where files are listed.
        self._schema = T.StructType([f for f in schema.fields if f.name != partition])
        df = self._data()
        if partition not in df.columns:
            raise ValueError(f"{path} has no partitions by {partition}")
        self.parts, measures = _shared_parts(df, suite, _CHECKS_OF_COUNTS)
        self.numeric = numeric_columns(df)
        self.measures = {ROWS: _Measure("*", F.count(F.lit(1)))} | measures | _moments(df, self.numeric)
        self.scans = [[ROWS] + [n for n in names if n != ROWS] for names in _scans(self.measures)]
        self.keys = list(suite.key_columns) if suite.key_columns is not None else ["id"] if "id" in df.columns else []
        try:
            self._keyed = df.select(*key_columns(df, self.keys)).schema if self.keys else None
        except AnalysisException:
            self._keyed = None
        told = [df.schema.json(), partition, str(self._keyed), *(f"{n} {m.aggregate}" for n, m in self.measures.items())]
        self.root = f"{store.rstrip('/')}/{hashlib.sha256(chr(0).join(told).encode()).hexdigest()[:32]}"

    def _data(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.path)

    def _of(self, df: DataFrame, values: list) -> DataFrame:
        """The rows of some partitions, named to the reader."""
        known = [v for v in values if v is not None]
        wanted = ref(self.partition).isin(known) if known else F.lit(False)
        return df.where(wanted | ref(self.partition).isNull() if len(known) < len(values) else wanted)

    def _states(self) -> DataFrame:
        """``value, part, state`` of each partition as its files are now. No file is opened."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.path)
        told = F.xxhash64("path", "length", "modificationTime")
        state = F.concat_ws(":", F.count(F.lit(1)), F.sum("length"), F.hex(F.bit_xor(told)))
        states = files.groupBy(ref(self.partition).alias("value")).agg(state.alias(STATE))
        return states.select("value", F.col("value").cast("string").alias(PART), STATE)

    def _log(self, scan: int) -> DataFrame:
        """All that was ever measured by a scan."""
        path, names = f"{self.root}/scan-{scan}", self.scans[scan]
        fields = self._data().agg(*(self.measures[n].aggregate.alias(n) for n in names)).schema.fields
        schema = T.StructType([T.StructField(PART, T.StringType()), T.StructField(STATE, T.StringType()), *fields])
        if not children(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        return left[PART].eqNullSafe(right[PART]) & (left[STATE] == right[STATE])

    def _kept(self, states: DataFrame, scan: int) -> DataFrame:
        """What is known of the partitions as they are now. A run lost half way may have left a row twice."""
        log = self._log(scan)
        return log.join(states, self._same(log, states), "left_semi").dropDuplicates([PART]).where(F.col(ROWS) > 0)

    def _measured(self, df: DataFrame, names: list[str], broken: frozenset[str]) -> DataFrame:
        missing = F.max(F.lit(None).cast("long"))
        lost = {n for n in names if n.startswith("custom_") and self.measures[n].column in broken}
        aggregates = [(missing if n in lost else self.measures[n].aggregate).alias(n) for n in names]
        return df.groupBy(ref(self.partition).cast("string").alias(PART)).agg(*aggregates)

    def _write(self, df: DataFrame, batch: DataFrame, broken: frozenset[str]) -> None:
        """Keep what a batch of partitions holds; the first scan comes last, and makes the rest valid."""
        if self._keyed is not None:
            keyed = df.select(ref(self.partition).cast("string").alias(PART), *key_columns(df, self.keys))
            counted = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("copies"))
            writer = counted.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PART).parquet(f"{self.root}/keys")
        for scan in reversed(range(len(self.scans))):
            found = self._measured(df, self.scans[scan], broken)
            rows = batch.join(found, batch[PART].eqNullSafe(found[PART]), "left").drop(found[PART])
            rows = rows.withColumn(ROWS, F.coalesce(ROWS, F.lit(0))).select(*self._log(scan).columns)
            rows.coalesce(1).write.mode("append").parquet(f"{self.root}/scan-{scan}")

    def refresh(self, states: DataFrame | None = None) -> int:
        """Measure the partitions whose files changed, a batch at a time; their number."""
        scratch = None
        if states is None:
            scratch = Scratch(self.spark, "partition-states")
            states = scratch.settle(self._states())
        done = 0
        while True:
            log = self._log(0)
            changed = states.join(log, self._same(states, log), "left_anti").limit(PARTITIONS_PER_BATCH).collect()
            if not changed:
                break
            df = self._of(self._data(), [r.value for r in changed])
            batch = self.spark.createDataFrame([(r[PART], r[STATE]) for r in changed], f"{PART} string, {STATE} string")
            try:
                self._write(df, batch, frozenset())
            except DATA_ERRORS:
                broken = _broken_rules(df, self.suite)
                if not broken:
                    raise
                self._write(df, batch, broken)
            done += len(changed)
        if scratch:
            scratch.close()
        return done

    def results(self) -> DataFrame:
        """Refresh, and the rows of ``run_checks`` for the dataset as it is."""
        scratch = Scratch(self.spark, "partition-states")
        states = scratch.settle(self._states())
        self.refresh(states)
        kept = [self._kept(states, scan) for scan in range(len(self.scans))]
        together = [merged(k if i == 0 else k.drop(ROWS)).drop("partitions") for i, k in enumerate(kept)]
        shared = _side_by_side(together)
        own = [self._outliers(kept, shared), self._duplicates(states), self._skew(kept[0])]
        drafts = [p.draft for p in [*self.parts.values(), *own] if isinstance(p, _Part)]
        frames = [_verdicts(shared, drafts), *(f for f in own if isinstance(f, DataFrame))]
        found = settled(reduce(DataFrame.unionByName, frames))
        scratch.close()
        return found

    def _outliers(self, kept: list[DataFrame], shared: DataFrame) -> DataFrame | _Part:
        if not self.numeric:
            return _skip("anomalies")
        row, df = shared.first().asDict(), self._data()
        bounds = _bounds(row, self.numeric, self.suite.sigma)
        beyond = []
        for frame in kept:
            tests = [
                (F.col(f"min_{i}") < F.lit(bounds[c].low)) | (F.col(f"max_{i}") > F.lit(bounds[c].high)) | (F.col(f"infinite_{i}") > 0)
                for i, c in enumerate(self.numeric)
                if c in bounds and f"min_{i}" in frame.columns
            ]
            if tests:
                beyond.append(frame.where(reduce(Column.__or__, tests)).select(PART))
        if beyond:
            parts = reduce(DataFrame.union, beyond).distinct().limit(PARTITIONS_PER_BATCH + 1)
            parts = parts.select(F.col(PART).cast(df.schema[self.partition].dataType)).collect()
            if len(parts) <= PARTITIONS_PER_BATCH:  # too many to name: all are read
                df = self._of(df, [r[0] for r in parts])
        return _anomalies(df, self.suite, self.numeric, row)

    def _duplicates(self, states: DataFrame) -> DataFrame | _Part:
        if not self.keys:
            return _skip("duplicates")
        if self._keyed is None:
            return _error("duplicates", self.suite)
        lost = self.suite.deductions["duplicates"]
        draft = _draft("duplicates", {", ".join(self.keys): "duplicates"}, lost, number="duplicates")
        path = f"{self.root}/keys"
        schema = T.StructType([*self._keyed.fields, T.StructField("copies", T.LongType()), T.StructField(PART, T.StringType())])
        keys = self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)
        keys = keys.join(states, keys[PART].eqNullSafe(states[PART]), "left_semi")
        per_key = keys.groupBy(*self._keyed.names).agg(F.sum("copies").alias("copies"))
        return _verdicts(per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates")), [draft])

    def _skew(self, kept: DataFrame) -> DataFrame | _Part:
        column = self.suite.partition_column
        if column != self.partition:
            return _distribution(self._data(), self.suite)
        skew = skew_of(kept.select(F.col(ROWS).alias("count")), self.suite.skew_factor)
        lost = self.suite.deductions["distribution"]
        return _verdicts(skew, [_draft("distribution", {column: "if(skewed, 1, 0)"}, lost, **_skipped_if("partitions = 0"))])
