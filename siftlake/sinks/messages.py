"""Publishing rows as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from siftlake.functions.codec import encode_row, to_messages


def publish_files(df: DataFrame, path: str, partition: Column, offset: Column, charset: str = "utf-8") -> None:
    """Append rows to a folder that :class:`siftlake.sources.messages.MessageFiles` reads."""
    to_messages(df, partition, offset, charset).write.mode("append").parquet(path)


def publish_topic(df: DataFrame, servers: str, topic: str, charset: str = "utf-8", **options: str) -> None:
    """Send rows to a topic and wait until all replicas have them. Needs Spark's Kafka connector."""
    (
        df.select(encode_row(df.columns, charset).alias("value"))
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"} | options)
        .save()
    )
