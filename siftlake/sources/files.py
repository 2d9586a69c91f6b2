"""Incremental file source: each run sees the files that arrived since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siftlake.sources.schema_log import SchemaLog


def incremental_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    glob: str = "*.parquet",
    max_files_per_trigger: int | None = None,
    schema_log: SchemaLog | None = None,
) -> DataFrame:
    """A stream over the Parquet files below ``path``. Which files were seen is kept in the query's checkpoint.

    Without ``schema`` the columns are those of the newest version in ``schema_log``, by default the log beside the dataset;
    no file is opened to know them, unless there is no log yet. Files that were removed after a batch was planned count as
    empty, since whoever replaced them wrote others.
    """
    if schema is None:
        schema = (schema_log or SchemaLog.beside(spark, path)).of_dataset(path, glob)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("ignoreMissingFiles", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
