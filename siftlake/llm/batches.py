"""How many rows Spark hands to Python at once."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

# Rows are handed over in batches of about so many bytes, in place of 10 000 rows whatever their size.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


@contextmanager
def small_batches(spark: SparkSession):
    """The session's setting is changed for jobs that run inside."""
    setting, size = BATCH
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, size)
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
