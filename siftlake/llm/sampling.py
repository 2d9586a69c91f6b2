"""Samples that the driver can hold whatever the texts are like."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlake.workspace import Scratch

# Texts that a classifier is fitted to, in bytes: of all together, and of one. Longer ones are not learned from.
SAMPLE_BYTES = 1 << 26
TEXT_BYTES = 1 << 21


def sample(rows: DataFrame, sample_bytes: int = SAMPLE_BYTES, text_bytes: int = TEXT_BYTES) -> pa.Table:
    """Of ``rows`` (``doc_id, text`` and more), of which there is a bounded number, one for each id, in the order of a hash of the id
    until the bytes are used up; by id.

    Of several rows with an id the least by its other columns counts, so that reruns agree. Null texts have no bytes. No rows give an empty table.
    """
    scratch = Scratch(rows.sparkSession, "sample")
    others = F.struct(*(c for c in rows.columns if c != "doc_id"))
    held = scratch.settle(rows.groupBy("doc_id").agg(F.min(others).alias("least")).select("doc_id", "least.*"), "rows")
    sizes = held.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    sizes = sizes.where(F.col("bytes") <= text_bytes)
    # The number of rows is bounded: one task may order their ids.
    running = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    within = sizes.withColumn("upto", F.sum("bytes").over(running)).where(F.col("upto") <= sample_bytes)
    table = held.join(F.broadcast(within.select("doc_id")), "doc_id").orderBy("doc_id").toArrow()
    scratch.close()
    return table
