"""The three layers in the session catalog."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.schemas import BRONZE_SCHEMA, PARTITION_COLUMN, RAW_SCHEMA

# Layer and table names, and the fields of the gold table.
LAYERS = ("bronze", "silver", "gold")
BRONZE_TABLE = "events_raw"
SILVER_TABLE = "events_cleaned"
GOLD_TABLE = "events_metrics"
GOLD_DAILY_TABLE = "events_metrics_by_date"
GOLD_COLUMNS = (
    "event_type STRING, total_events BIGINT, avg_value DOUBLE, min_value INT, max_value INT, calculated_at TIMESTAMP"
)

# The partition of a silver row: its id dealt out by hash.
ID_PART = "id_part"

SILVER_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField("processed_at", T.TimestampType())])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    """One schema per layer, below ``location`` when given."""
    names = [prefix + layer for layer in LAYERS]
    for name, layer in zip(names, LAYERS):
        place = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT 'Events, {layer} layer'{place}")
    return names


def create_bronze_table(
    spark: SparkSession, schema_name: str, location: str, columns: T.StructType = BRONZE_SCHEMA
) -> str:
    """The exported dataset as an external table. Its partitions are registered too: without that the table reads as
    empty although the files are there."""
    name = f"{schema_name}.{BRONZE_TABLE}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(columns)}) USING PARQUET "
        f"PARTITIONED BY ({PARTITION_COLUMN}) LOCATION '{location}'"
    )
    add_columns(spark, name, columns)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def add_columns(spark: SparkSession, table: str, columns: T.StructType) -> None:
    """Columns that a table of the catalog lacks, at the end of its own; rows written before read as NULL there."""
    known = {c.lower() for c in spark.table(table).columns}
    fresh = T.StructType([f for f in columns.fields if f.name.lower() not in known])
    if fresh.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_ddl(fresh)})")


def create_silver_table(
    spark: SparkSession,
    schema_name: str,
    columns: T.StructType = SILVER_SCHEMA,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> str:
    """With ``buckets`` the table is laid out for increments: partitions by ``ID_PART``, each in so many buckets by ``id``, and
    an overwrite replaces only the partitions it writes."""
    name, layout = f"{schema_name}.{SILVER_TABLE}", ""
    if buckets:
        layout = (
            f" OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({ID_PART}) CLUSTERED BY (id) INTO {buckets} BUCKETS"
        )
        columns = T.StructType([*columns.fields, T.StructField(ID_PART, T.IntegerType())])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(columns)}) USING {fmt}{layout} COMMENT 'Complete events, once per id'"
    )
    add_columns(spark, name, columns)
    return name


def create_gold_table(
    spark: SparkSession, schema_name: str, columns: str = GOLD_COLUMNS, fmt: str = "parquet", table: str = GOLD_TABLE
) -> str:
    name = f"{schema_name}.{table}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} COMMENT 'Event metrics'")
    return name


def refill(df: DataFrame, table: str) -> None:
    """Replace the rows of a table by these, matched by column name and cast to the table's types."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in target.fields]).write.insertInto(table, overwrite=True)


def catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def table_inventory(spark: SparkSession, schema_names: Sequence[str] = LAYERS) -> DataFrame:
    """``table_name, schema_name, table_type, created_at`` of the tables and views in these schemas, in order."""
    rows = []
    for schema_name in schema_names:
        for table in spark.catalog.listTables(schema_name):
            if table.isTemporary:
                continue
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {schema_name}.`{table.name}` AS JSON").first()[0]
            about = json.loads(described)
            rows.append((table.name, schema_name, about.get("type"), about.get("created_time")))
    found = spark.createDataFrame(
        rows, "table_name string, schema_name string, table_type string, created_at string"
    )
    return found.withColumn("created_at", F.col("created_at").cast("timestamp")).orderBy("schema_name", "table_name")
