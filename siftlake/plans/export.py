"""Vet a raw table and export it only when it passes."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.functions.columns import with_partition_date
from siftlake.functions.predicates import is_negative, not_in_set
from siftlake.operators.quality import QualitySuite, report, run_checks, settled
from siftlake.schemas import (
    CRITICAL_COLUMNS,
    EVENT_TYPES,
    EXPECTED_COLUMNS,
    PARTITION_COLUMN,
    VALUE_RANGES,
)
from siftlake.sinks.exports import write_by_date

log = logging.getLogger(__name__)


def event_suite(df: DataFrame) -> QualitySuite:
    """The checks of an event export. A rule whose column is absent holds."""
    rules = {
        "event_type_valid": ("type", not_in_set("type", EVENT_TYPES)),
        "value_not_negative": ("value", is_negative("value")),
    }
    return QualitySuite(
        expected_columns=EXPECTED_COLUMNS,
        critical_columns=CRITICAL_COLUMNS,
        key_columns=("id", "timestamp"),
        numeric_ranges=VALUE_RANGES,
        partition_column=PARTITION_COLUMN,
        rules={name: bad if column in df.columns else F.lit(False) for name, (column, bad) in rules.items()},
    )


@dataclass(frozen=True)
class Export:
    """Check results, their one-row report, and whether the dataset was written."""

    results: DataFrame
    report: DataFrame
    exported: bool


def gated_export(df: DataFrame, path: str, suite: QualitySuite | None = None, **write_options) -> Export:
    """Run the checks; write ``df`` by date when the gate opens, leave ``path`` alone when it does not.

    The date is added first, so that the distribution check sees the partitions that would be written. ``df`` should be
    a stored table: it is read once per scan of the checks and once more for the export.
    """
    dated = with_partition_date(df)
    results = settled(run_checks(dated, suite or event_suite(dated)).orderBy("position"))
    summary = settled(report(results))
    exported = bool(summary.first()["can_upload"])
    if exported:
        write_by_date(dated, path, **write_options)
    else:
        log.error("quality gate closed, nothing written to %s", path)
    return Export(results, summary, exported)
