"""Schemas and column lists shared by the jobs, and the type classes the checks work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names, types and order of the event data model.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("value", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.BinaryType()),
    ]
)
CRITICAL_COLUMNS = ("id", "value", "type", "timestamp")
EXPECTED_COLUMNS = CRITICAL_COLUMNS + ("ingested_at", "kafka_partition", "kafka_offset")
EVOLUTION_COLUMNS = CRITICAL_COLUMNS + ("ingested_at",)
PARTITION_COLUMN = "ingestion_date"
EVENT_TYPES = ("test_event", "production_event", "debug_event")
VALUE_RANGES = {"value": (0, 1_000_000), "timestamp": (0, 9_999_999_999_999)}

# The stored ("raw") form adds message metadata and the ingest time; the exported form adds the date.
RAW_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields
    + [
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
BRONZE_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField(PARTITION_COLUMN, T.DateType())])


def with_types(schema: T.StructType, **types: T.DataType) -> T.StructType:
    """The same fields with some types replaced, e.g. ``id`` as LONG beyond two billion events."""
    unknown = set(types) - set(schema.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return T.StructType(
        [T.StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in schema.fields]
    )


def quoted(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ref(name: str) -> Column:
    """A column by its exact top-level name, also when the name holds dots or backticks."""
    return F.col(quoted(name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)
