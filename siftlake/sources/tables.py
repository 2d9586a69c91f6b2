"""Batch scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftlake.sources.schema_log import SchemaLog


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """A stored dataset; Hive-style partition directories become columns. ``merge_schema`` unites the columns of files
    written before and after a schema change: those in the log beside the dataset, or without a log those of all files."""
    reader = spark.read.format(fmt)
    if merge_schema:
        known = SchemaLog.beside(spark, path).latest() if fmt == "parquet" else None
        reader = reader.option("mergeSchema", "true") if known is None else reader.schema(known)
    return reader.load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
