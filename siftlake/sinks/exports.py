"""Parquet exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siftlake.functions.columns import with_partition_date
from siftlake.schemas import PARTITION_COLUMN
from siftlake.sources.schema_log import SchemaLog


def write_plain(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def write_by_date(
    df: DataFrame,
    path: str,
    replace_all: bool = True,
    rebalance: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """Overwrite a Parquet dataset partitioned by ``ingestion_date``.

    ``replace_all`` drops the dates that the input lacks; otherwise only the dates in the input are replaced.

    Rows are rebalanced by date first: a date becomes few files of AQE's advisory size, and one that holds much of the
    data is split over several tasks. ``rebalance=False`` writes the rows as they lie, without a shuffle: for tables
    known to be in date order, where each task writes its one or two dates.

    The schema log beside the dataset gets its columns: new ones before the first row is written, or all of them anew when
    everything has been replaced.
    """
    df = with_partition_date(df)
    if rebalance:
        df = df.hint("rebalance", PARTITION_COLUMN)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    log = SchemaLog.beside(df.sparkSession, path)
    if not replace_all:
        log.add(df.schema)
    writer.partitionBy(PARTITION_COLUMN).parquet(path)
    if replace_all:
        log.add(df.schema, anew=True)
