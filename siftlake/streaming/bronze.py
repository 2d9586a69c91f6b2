"""Exports to bronze: by the files that are new, so that any export may be loaded again."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from siftlake.schemas import PARTITION_COLUMN
from siftlake.sinks.exports import write_by_date
from siftlake.sources.files import incremental_parquet
from siftlake.sources.schema_log import SchemaLog
from siftlake.workspace import Scratch, children, exists, remove

# Files of one batch. Their names are what the driver holds of a batch, for the stream's own log as for this module.
FILES_PER_BATCH = 10_000
# Where each row of a batch comes from.
FILE = "siftlake_file"


def _footers(spark: SparkSession, dataset: str, files: list[str]) -> T.StructType | None:
    """The united columns of some files of a dataset; None when they are all gone."""
    read = spark.read.option("mergeSchema", "true").option("basePath", dataset)
    try:
        return read.parquet(*files).schema if files else None
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return _footers(spark, dataset, [f for f in files if exists(spark, f)])


def each_new_batch(
    spark: SparkSession,
    export_path: str,
    checkpoint: str,
    load: Callable[[DataFrame, int, T.StructType], None],
    schema: T.StructType | None = None,
    max_files: int = FILES_PER_BATCH,
) -> None:
    """Call ``load`` with the rows of the files that are new since the last call, the number of the batch and the columns
    known so far, until no file is new. A batch whose ``load`` did not end comes again with the same number and files.

    The footers of new files are opened, those only, and their new columns become a version of the export's schema log.
    The rows have all known columns and ``FILE``.
    """
    log = SchemaLog.beside(spark, export_path)
    new_files = incremental_parquet(spark, export_path, schema, max_files_per_trigger=max_files)
    columns = new_files.schema

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows, known = batch, columns
        if schema is None:
            files = [unquote(row[0]) for row in batch.select(FILE).distinct().collect()]
            found = _footers(session, export_path, files)
            if found is None:
                return
            known = log.add(found)
            if set(known.names) != set(columns.names):  # the stream was planned without some of these
                again = session.read.schema(known).option("basePath", export_path).option("ignoreMissingFiles", "true")
                present = [f for f in files if exists(session, f)]
                rows = again.parquet(*present).withColumn(FILE, F.col("_metadata.file_path"))
        load(rows, number, known)

    named = new_files.withColumn(FILE, F.col("_metadata.file_path"))
    query = named.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def load_bronze(
    spark: SparkSession,
    export_path: str,
    bronze_path: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int = FILES_PER_BATCH,
) -> None:
    """Bring the bronze dataset up to what the export holds, reading only dates with files that are new since the last call.

    Each of these dates is replaced as a whole by what the export holds for it now, whether files were added to it or it was
    written again. So a second whole export leaves every row there once, and a batch that was lost half way may be repeated.
    Dates that the export no longer has go. An export without dates is copied as a whole when any file of it is new.

    The ledger beside the checkpoint has a row per batch and date: ``generation``, ``ingestion_date``, ``files``, ``rows``.
    """

    def load(batch: DataFrame, number: int, known: T.StructType) -> None:
        session = batch.sparkSession
        held = session.read.schema(known).option("ignoreMissingFiles", "true").parquet(export_path)
        if PARTITION_COLUMN not in known.names:
            held.write.mode("overwrite").parquet(bronze_path)
            SchemaLog.beside(session, bronze_path).add(known, anew=True)
        else:
            scratch = Scratch(session, "bronze")
            per_date = batch.groupBy(PARTITION_COLUMN).agg(
                F.count_distinct(FILE).alias("files"), F.count(F.lit(1)).alias("rows")
            )
            per_date = scratch.settle(per_date, "dates")
            # The join prunes the export's folders; an undated row is equal to no date.
            dated = held.join(per_date.select(PARTITION_COLUMN), PARTITION_COLUMN, "left_semi")
            if not per_date.where(F.col(PARTITION_COLUMN).isNull()).isEmpty():
                dated = dated.unionByName(held.where(F.col(PARTITION_COLUMN).isNull()))
            write_by_date(dated.select(*known.names), bronze_path, replace_all=False)
            per_date.write.mode("overwrite").parquet(f"{ledger_path(checkpoint)}/generation={number}")
            scratch.close()

    each_new_batch(spark, export_path, checkpoint, load, schema, max_files_per_trigger)
    _drop_vanished_dates(spark, export_path, bronze_path)


def ledger_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-ledger"


def _drop_vanished_dates(spark: SparkSession, export_path: str, bronze_path: str) -> None:
    folders = lambda path: {n for n in children(spark, path) if n.startswith(f"{PARTITION_COLUMN}=")}
    there = folders(export_path)
    if there:
        for name in sorted(folders(bronze_path) - there):
            remove(spark, f"{bronze_path}/{name}")
