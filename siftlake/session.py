"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Any size: dates do not depend on the machine's zone; AQE merges small shuffle partitions and splits hot ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Many terabytes: larger scan splits keep the task count of a one-row aggregate in the hundreds of thousands, a high
# initial partition number keeps each reducer's share of a key set in memory (AQE merges what turns out small).
LARGE_CONF = BASE_CONF | {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def make_session(app_name: str, conf: Mapping[str, str] = BASE_CONF) -> SparkSession:
    """A session with these settings; master and storage credentials come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
