"""Message bytes to text to typed columns, and back: JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.schemas import EVENT_SCHEMA, ref

# The charset names users may configure.
CHARSETS = ("utf-8", "utf-8-sig", "latin-1", "ascii")

REPLACEMENT = "�"
_BOM = "﻿"
_NON_ASCII = r"[^\x00-\x7F]"


def _require_charset(charset: str) -> None:
    if charset not in CHARSETS:
        raise ValueError(f"unsupported charset {charset!r}; choose one of {', '.join(CHARSETS)}")


def decode_text(value: Column, charset: str = "utf-8") -> Column:
    """Bytes as text. Malformed input becomes U+FFFD instead of failing the task, so that a single bad message
    cannot stop a stream and the encoding check can count it."""
    _require_charset(charset)
    value = value.cast("binary")
    if charset in ("utf-8", "utf-8-sig"):
        text = F.make_valid_utf8(value.cast("string"))
        if charset == "utf-8-sig":
            text = F.when(text.startswith(_BOM), F.substr(text, F.lit(2))).otherwise(text)
        return text
    text = F.decode(value, "ISO-8859-1")
    if charset == "ascii":
        text = F.regexp_replace(text, _NON_ASCII, REPLACEMENT)
    return text


def _is_ascii(text: Column) -> Column:
    """As many bytes as characters: cheaper than a pattern."""
    return F.octet_length(text) == F.length(text)


def escape_non_ascii(json: Column) -> Column:
    """JSON text with every non-ASCII character as \\uXXXX (surrogate pairs beyond the BMP)."""

    def escaped(char: Column) -> Column:
        units = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        return F.when(_is_ascii(char), char).otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))

    return F.when(_is_ascii(json), json).otherwise(F.array_join(F.transform(F.split(json, ""), escaped), ""))


def encode_row(columns: list[str], charset: str = "utf-8") -> Column:
    """One row as JSON bytes. The JSON is pure ASCII, so every supported charset can hold it."""
    _require_charset(charset)
    json = F.to_json(F.struct(*[ref(c) for c in columns]), {"ignoreNullFields": "false"})
    body = escape_non_ascii(json)
    if charset == "utf-8-sig":
        body = F.concat(F.lit(_BOM), body)
    return F.encode(body, "UTF-8")


def to_messages(df: DataFrame, partition: Column, offset: Column, charset: str = "utf-8") -> DataFrame:
    """Rows as ``partition, offset, value`` messages."""
    return df.select(
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        encode_row(df.columns, charset).alias("value"),
    )


def message_text(messages: DataFrame, charset: str = "utf-8") -> DataFrame:
    """Messages as ``kafka_partition, kafka_offset, text``."""
    return messages.select(
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        decode_text(F.col("value"), charset).alias("text"),
    )


def parse_messages(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA, charset: str = "utf-8") -> DataFrame:
    """Messages as typed columns plus ``kafka_partition, kafka_offset``.

    No message is dropped: what does not parse becomes NULL fields, which the null check finds.
    """
    events = message_text(messages, charset).withColumn("event", F.from_json("text", schema))
    return events.select("event.*", "kafka_partition", "kafka_offset")
