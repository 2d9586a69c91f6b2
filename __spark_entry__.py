"""

The tables are clean, so some queries look at them through expressions that leave real defects, the same in both
engines: 'error' as a missing event type, UTF-8 text read as ASCII, users as event ids, value bands with one hot band.
"""

from __future__ import annotations

import importlib
import math
from collections.abc import Callable
from functools import reduce, wraps
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake import catalog
from siftlake.functions.codec import (
    CHARSETS,
    REPLACEMENT,
    decode_text,
    encode_row,
    message_text,
    parse_messages,
    to_messages,
)
from siftlake.functions.columns import epoch_millis, stamp_ingest, with_partition_date
from siftlake.functions.predicates import is_negative, not_in_set
from siftlake.operators import layers, mutations, profile, quality
from siftlake.operators.quality import QualitySuite, findings, measured, report, run_checks
from siftlake.operators.quality_store import PartitionChecks
from siftlake.plans import lake_validation
from siftlake.plans.export import event_suite, gated_export
from siftlake.plans.flow import fill_layers, run_flow
from siftlake.schemas import (
    CRITICAL_COLUMNS,
    EVENT_SCHEMA,
    EXPECTED_COLUMNS,
    with_types,
)
from siftlake.sinks.exports import write_by_date, write_plain
from siftlake.sinks.messages import publish_files
from siftlake.sources.generated import events_for
from siftlake.sources.messages import MessageFiles
from siftlake.sources.tables import read_path, read_table
from siftlake.streaming.bronze import load_bronze
from siftlake.streaming.ingest import ingest_events
from siftlake.streaming.live import BatchCounts, ingest_watched
from siftlake.workspace import new_path, use_local_root

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KINDS = ("view", "click", "purchase", "signup", "error")
_BEYOND_DOUBLE = 9_007_199_254_740_993
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")
# The tables' ids are BIGINT.
WIDE_EVENT = with_types(EVENT_SCHEMA, id=T.LongType())


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the shape of a raw table with its date."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "value",
        F.col("event_type").alias("type"),
        epoch_millis(F.col("ts")).alias("timestamp"),
        F.pmod("event_id", F.lit(4)).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        F.col("ts").cast("date").alias("ingestion_date"),
    )


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).withColumn("type", F.nullif("type", F.lit("error")))


def _by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flawed events with the user as id: many rows per id."""
    users = _table(spark, sf_dir, "events").withColumnsRenamed({"event_id": "kafka_offset", "user_id": "id"})
    return users.select(
        "id",
        "value",
        F.nullif("event_type", F.lit("error")).alias("type"),
        epoch_millis(F.col("ts")).alias("timestamp"),
        F.pmod("kafka_offset", F.lit(4)).cast("int").alias("kafka_partition"),
        "kafka_offset",
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by value band; the band below 20 holds a third of them."""
    band = F.when(F.col("value") < 20, F.lit(-1)).otherwise(F.floor("value")).cast("long")
    return _table(spark, sf_dir, "events").select("event_id", band.alias("band"))


def _test_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts")
    return events_for(events, sent_at=F.col("ts"))


def _message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("id", F.col("value").cast("int").alias("value"), "type", "timestamp")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages; an 'error' event is cut off in the middle."""
    sent = to_messages(_message_rows(spark, sf_dir), F.pmod("id", F.lit(4)), F.col("id"))
    broken = F.expr("if(contains(decode(value, 'UTF-8'), '\"error\"'), substring(value, 1, 9), value)")
    return sent.withColumn("value", broken)


def _suite(**options) -> QualitySuite:
    return QualitySuite(
        expected_columns=EXPECTED_COLUMNS,
        critical_columns=CRITICAL_COLUMNS,
        key_columns=("id", "timestamp"),
        numeric_ranges={"value": (0, 100), "timestamp": (0, 9_999_999_999_999)},
        partition_column="ingestion_date",
        rules={"event_type_valid": not_in_set("type", KINDS), "value_not_negative": is_negative("value")},
        **options,
    )


_SHOWN = ["check", "status", "violations", "detail", "deduction"]


def _checked(df: DataFrame, suite: QualitySuite, *only: str) -> DataFrame:
    return run_checks(df, suite, only).select(_SHOWN)


# --- queries -------------------------------------------------------------------------------------------------------


def row_count(spark, sf_dir):
    return profile.row_count(_table(spark, sf_dir, "lineitem"))


def dataset_stats(spark, sf_dir):
    per_table = [
        profile.dataset_stats(_table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "total_rows", "schema_columns")
        for t in TABLES
    ]
    return reduce(DataFrame.union, per_table)


def numeric_profile(spark, sf_dir):
    found = profile.numeric_profile(_table(spark, sf_dir, "lineitem"))
    return found.withColumns({"avg": F.round("avg", 6), "stddev": F.round("stddev", 6)})


def exact_extremes(spark, sf_dir):
    """Ids beyond what doubles hold."""
    wide = _table(spark, sf_dir, "events").select((F.col("event_id") + _BEYOND_DOUBLE).alias("wide_id"))
    return profile.numeric_profile(wide).select("column", "min_exact", "max_exact", "count")


def dq_infinite(spark, sf_dir):
    """A column with NaN and both infinities."""
    every = F.pmod("event_id", F.lit(100))
    odd = F.when(every == 7, F.lit(math.nan)).when(every == 8, F.lit(math.inf)).when(every == 9, F.lit(-math.inf))
    return _checked(_table(spark, sf_dir, "events").select(odd.otherwise(F.lit(1.0)).alias("value")), QualitySuite(), "anomalies")


def dq_broken_rule(spark, sf_dir):
    """A rule that fails on the data next to one that does not."""
    suite = QualitySuite(rules={"broken": "cast(event_type AS int) < 0", "negative": "value < 0"})
    results = run_checks(_table(spark, sf_dir, "events"), suite, ["row_count", "custom"])
    return results.select("check", "status", "deduction")


def schema_growth(spark, sf_dir):
    """The layers after a first export without a column and a second one with it."""
    events, path = _events(spark, sf_dir).where("value IS NOT NULL"), new_path(spark, "growth")
    export, layers_at, prefix = f"{path}/export", f"{path}/layers", f"growth_{path[-32:]}_"
    write_by_date(events.where("id % 2 = 0"), export)
    fill_layers(spark, export, layers_at, prefix)
    noted = events.where("id % 2 = 1").withColumn("note", F.concat(F.lit("n"), "id"))
    noted.write.mode("append").partitionBy("ingestion_date").parquet(export)
    fill_layers(spark, export, layers_at, prefix)
    return spark.table(f"{prefix}silver.events_cleaned").select("id", "note")


def type_frequency(spark, sf_dir):
    return profile.value_frequency(_events(spark, sf_dir), "type", top=20)


def top_values(spark, sf_dir):
    return profile.top_values(_table(spark, sf_dir, "lineitem"), "l_partkey").union(
        profile.top_values(_table(spark, sf_dir, "events"), "user_id", 5)
    )


def dq_measured(spark, sf_dir):
    df = _flawed(spark, sf_dir).select("id", "value", "type", "ingestion_date")
    return measured(df, QualitySuite(expected_columns=("id", "value", "lost"), partition_column="ingestion_date")).select(
        "check", "column", "measure", F.round("value", 6).alias("value")
    )


def rows_per_date(spark, sf_dir):
    return profile.rows_per_date(_events(spark, sf_dir), first=None)


def first_dates(spark, sf_dir):
    return profile.rows_per_date(_events(spark, sf_dir), first=10)


def max_string_length(spark, sf_dir):
    lengths = [
        profile.longest_strings(_table(spark, sf_dir, t)).withColumn("table_name", F.lit(t))
        for t in ("documents", "pages", "conversations")
    ]
    return reduce(DataFrame.unionByName, lengths)


def partition_skew(spark, sf_dir):
    return profile.partition_skew(_banded(spark, sf_dir), "band").withColumn("avg_rows", F.round("avg_rows", 6))


def duplicate_count(spark, sf_dir):
    by_text = profile.duplicate_count(_table(spark, sf_dir, "documents"), ["text"])
    by_pair = profile.duplicate_count(_by_user(spark, sf_dir), ["id", "type"])
    return by_text.withColumn("key", F.lit("text")).unionByName(by_pair.withColumn("key", F.lit("user, type")))


def dq_schema(spark, sf_dir):
    return _checked(_table(spark, sf_dir, "events"), _suite(), "row_count", "schema")


def dq_nulls(spark, sf_dir):
    return _checked(_flawed(spark, sf_dir), _suite(), "nulls")


def dq_duplicates(spark, sf_dir):
    return _checked(_by_user(spark, sf_dir), QualitySuite(key_columns=["id", "type"]), "duplicates")


def dq_ranges(spark, sf_dir):
    limits = {"value": (0, 100), "kafka_partition": (0, 3), "timestamp": (1_704_412_800_000, 9_999_999_999_999)}
    return _checked(_events(spark, sf_dir), QualitySuite(numeric_ranges=limits), "ranges")


def dq_data_types(spark, sf_dir):
    return _checked(_table(spark, sf_dir, "documents"), QualitySuite(max_string_length=20_000), "data_types")


def dq_anomalies(spark, sf_dir):
    return _checked(_events(spark, sf_dir), QualitySuite(), "anomalies")


def dq_distribution(spark, sf_dir):
    return _checked(_banded(spark, sf_dir), QualitySuite(partition_column="band"), "distribution")


def dq_encoding(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    as_ascii = documents.withColumn("text", decode_text(F.encode("text", "UTF-8"), "ascii"))
    return _checked(as_ascii, QualitySuite(), "encoding")


def dq_custom(spark, sf_dir):
    rules = {
        "balance_not_negative": is_negative("c_acctbal"),
        "segment_known": not_in_set("c_mktsegment", SEGMENTS),
        "name_present": "c_name is null or c_name = ''",
    }
    return _checked(_table(spark, sf_dir, "customer"), QualitySuite(rules=rules), "custom")


def dq_run(spark, sf_dir):
    return run_checks(_flawed(spark, sf_dir), _suite()).select(_SHOWN)


def dq_increments(spark, sf_dir):
    """The checks of a dataset by date that grew in three steps, from what is kept per date."""
    path, flawed = new_path(spark, "growing"), _flawed(spark, sf_dir)
    for some, late in (("id % 3 = 1", False), ("id % 3 = 2", True), ("id % 3 = 0", True)):
        batch = flawed.where(some)
        if late:
            batch.hint("rebalance", "ingestion_date").write.mode("append").partitionBy("ingestion_date").parquet(f"{path}/data")
        else:
            write_by_date(batch, f"{path}/data")
        PartitionChecks(spark, f"{path}/data", f"{path}/store", _suite()).refresh()
    return PartitionChecks(spark, f"{path}/data", f"{path}/store", _suite()).results().select(_SHOWN)


def dq_findings(spark, sf_dir):
    return findings(run_checks(_flawed(spark, sf_dir), _suite()))


def dq_report(spark, sf_dir):
    flawed = report(run_checks(_flawed(spark, sf_dir), _suite())).withColumn("dataset", F.lit("flawed"))
    intact = report(run_checks(_events(spark, sf_dir), _suite())).withColumn("dataset", F.lit("intact"))
    return flawed.unionByName(intact)


def dq_export_suite(spark, sf_dir):
    sent = _test_events(spark, sf_dir)
    raw = sent.select(
        "*",
        F.pmod("id", F.lit(4)).cast("int").alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        F.timestamp_millis("timestamp").alias("ingested_at"),
    )
    dated = with_partition_date(raw)
    return run_checks(dated, event_suite(dated)).select(_SHOWN)


def lake_checks(spark, sf_dir):
    return lake_validation.lake_checks(_flawed(spark, sf_dir)).results.select(_SHOWN)


def validation_report(spark, sf_dir):
    flawed = lake_validation.validation_report(_flawed(spark, sf_dir)).withColumn("dataset", F.lit("flawed"))
    intact = lake_validation.validation_report(_events(spark, sf_dir)).withColumn("dataset", F.lit("intact"))
    return flawed.unionByName(intact)


def generate_events(spark, sf_dir):
    return _test_events(spark, sf_dir)


def decode_bytes(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    decoded = documents.select(
        "doc_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("charset"), decode_text(F.encode("text", "UTF-8"), c).alias("text"))
                    for c in CHARSETS
                ]
            )
        ),
    )
    return decoded.select(
        "doc_id",
        "charset",
        F.length("text").alias("n_chars"),
        (F.length("text") - F.length(F.replace("text", F.lit(REPLACEMENT), F.lit("")))).alias("n_replaced"),
        F.when(F.col("charset").startswith("utf"), F.md5(F.encode("text", "UTF-8"))).alias("digest"),
    )


def parse_events(spark, sf_dir):
    return parse_messages(_messages(spark, sf_dir), WIDE_EVENT)


def encode_events(spark, sf_dir):
    rows = _message_rows(spark, sf_dir)
    message = encode_row(rows.columns)
    return rows.select("id", F.decode(message, "UTF-8").alias("message"), F.octet_length(message).alias("n_bytes"))


def ingestion_date(spark, sf_dir):
    return with_partition_date(_events(spark, sf_dir).drop("ingestion_date")).select("id", "ingestion_date")


def partitioned_export(spark, sf_dir):
    path = new_path(spark, "export")
    write_by_date(_events(spark, sf_dir), path)
    return read_path(spark, path).select("id", "value", "type", "timestamp", "ingestion_date")


def plain_export(spark, sf_dir):
    path = new_path(spark, "plain")
    for rows in (_table(spark, sf_dir, "nation").select("n_nationkey"), _table(spark, sf_dir, "orders")):
        write_plain(rows, path)
    return read_path(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


def published_messages(spark, sf_dir):
    topic = new_path(spark, "topic")
    publish_files(_message_rows(spark, sf_dir), topic, F.pmod("id", F.lit(4)), F.col("id"))
    return message_text(MessageFiles(topic).batch(spark))


def ingest_stamp(spark, sf_dir):
    stamped = stamp_ingest(_events(spark, sf_dir).drop("ingested_at"))
    per_stamp = stamped.groupBy("ingested_at").agg(F.count(F.lit(1)).alias("n"))
    return per_stamp.agg(F.sum("n").alias("total_rows"), F.count(F.lit(1)).alias("stamps"))


def gated_exports(spark, sf_dir):
    path, closed_path = new_path(spark, "gated"), new_path(spark, "gated")
    opened = gated_export(_events(spark, sf_dir), path, _suite())
    closed = gated_export(_flawed(spark, sf_dir), closed_path, _suite())
    written = profile.row_count(read_path(spark, path)).first()["total_rows"]
    outcome = lambda name, export, rows: export.report.select(
        F.lit(name).alias("dataset"),
        "quality_score",
        "can_upload",
        F.lit(export.exported).alias("exported"),
        F.lit(rows).cast("long").alias("rows_written"),
    )
    return outcome("intact", opened, written).unionByName(outcome("flawed", closed, 0))


def external_table(spark, sf_dir):
    path = new_path(spark, "external")
    write_by_date(_events(spark, sf_dir), path)
    (bronze, *_) = catalog.create_layers(spark, f"ext_{path[-32:]}_", new_path(spark, "layers"))
    name = catalog.create_bronze_table(spark, bronze, path, read_path(spark, path).schema)
    return read_table(spark, name).select("id", "value", "type", "kafka_partition", "kafka_offset", "ingestion_date")


_DELETE = "type <> 'view' and value > 20"


def delete_where(spark, sf_dir):
    path = new_path(spark, "table")
    _flawed(spark, sf_dir).drop("ingestion_date").write.parquet(path)
    target, _ = mutations.delete_from_path(spark, path, _DELETE)
    return read_path(spark, target).select("id", "value", "type")


def delete_counts(spark, sf_dir):
    path = new_path(spark, "table")
    write_by_date(_flawed(spark, sf_dir), path)
    (bronze, *_) = catalog.create_layers(spark, f"del_{path[-32:]}_", new_path(spark, "layers"))
    name = catalog.create_bronze_table(spark, bronze, path, read_path(spark, path).schema)
    some = "ingestion_date < date '2024-01-08' or (ingestion_date = date '2024-01-10' and type = 'click')"
    steps = [mutations.delete_from_table(spark, name, condition) for condition in (some, None)]
    labelled = [step.withColumn("step", F.lit(i)) for i, step in enumerate(steps, start=1)]
    return reduce(DataFrame.unionByName, labelled)


def delete_partitions(spark, sf_dir):
    """The rows left in a table of 60 partitions, of which 40 are emptied and some rewritten at once."""
    path = new_path(spark, "table")
    name = f"parts_{path[-32:]}"
    rows = _flawed(spark, sf_dir).select("id", "value", F.expr("pmod(id, 60)").alias("part")).repartition("part")
    rows.write.partitionBy("part").option("path", path).saveAsTable(name)
    mutations.delete_from_table(spark, name, "part < 40 or (part % 7 = 3 and value > 20)")
    return read_table(spark, name).select("id", "value")


def delete_preview(spark, sf_dir):
    return mutations.delete_preview(_flawed(spark, sf_dir), _DELETE)


def stream_ingest(spark, sf_dir):
    topic, table, checkpoint = (new_path(spark, p) for p in ("topic", "raw", "stream"))
    publish_files(_message_rows(spark, sf_dir), topic, F.pmod("id", F.lit(4)), F.col("id"))
    ingest_events(spark, MessageFiles(topic), table, checkpoint, schema=WIDE_EVENT)
    return read_path(spark, table).drop("ingested_at")


def stream_check(spark, sf_dir):
    topic, table, checkpoint = (new_path(spark, p) for p in ("topic", "raw", "stream"))
    _messages(spark, sf_dir).write.parquet(topic)
    check = ingest_events(spark, MessageFiles(topic), table, checkpoint, schema=WIDE_EVENT)
    total = check.stats.first()["total_rows"]
    return check.nulls.select(*_SHOWN, F.lit(total).cast("long").alias("total_rows"))


def live_checks(spark, sf_dir):
    """The counts of all micro-batches of two runs, added up."""
    topic, table, checkpoint, counts = (new_path(spark, p) for p in ("topic", "raw", "stream", "counts"))
    messages, written = _messages(spark, sf_dir), BatchCounts(spark, counts)
    for some in ("offset % 3 = 0", "offset % 3 <> 0"):
        messages.where(some).repartition(2).write.mode("append").parquet(topic)
        rows = ingest_watched(spark, MessageFiles(topic, 1), table, checkpoint, written, schema=WIDE_EVENT)
    return rows.agg(*(F.sum(name).alias(name) for name in written.names))


def incremental_files(spark, sf_dir):
    export, bronze, checkpoint = (new_path(spark, p) for p in ("export", "bronze", "stream"))
    events = _events(spark, sf_dir)
    write_by_date(events.filter("value < 20"), export)
    load_bronze(spark, export, bronze, checkpoint)
    events.filter("not value < 20").write.mode("append").partitionBy("ingestion_date").parquet(export)
    load_bronze(spark, export, bronze, checkpoint)
    return read_path(spark, bronze).select("id", "value", "type", "timestamp", "ingestion_date")


def bronze_reload(spark, sf_dir):
    """A whole export twice, the second time without the days before the fifth, then one day once more."""
    export, bronze, checkpoint = (new_path(spark, p) for p in ("export", "bronze", "stream"))
    events = _events(spark, sf_dir)
    write_by_date(events, export)
    load_bronze(spark, export, bronze, checkpoint)
    write_by_date(events.where("ingestion_date >= date '2024-01-05'"), export)
    load_bronze(spark, export, bronze, checkpoint)
    write_by_date(events.where("ingestion_date = date '2024-01-06'").withColumn("note", F.col("id") % 7), export, replace_all=False)
    load_bronze(spark, export, bronze, checkpoint)
    return read_path(spark, bronze, merge_schema=True).select("id", "value", "type", "ingestion_date", "note")


def silver_clean(spark, sf_dir):
    return layers.silver_events(_by_user(spark, sf_dir)).drop("processed_at")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_value", F.round("avg_value", 6))


def _incremented(spark, sf_dir) -> str:
    """The layers after three exports of what users did, each with some rows more; the last has late and repeated ones."""
    path = new_path(spark, "increments")
    export, prefix, rows = f"{path}/export", f"incr_{path[-32:]}_", _by_user(spark, sf_dir)
    for some in ("kafka_offset % 3 = 1", "kafka_offset % 3 = 2", "kafka_offset % 3 = 0 OR kafka_offset % 7 = 0"):
        write_by_date(rows.where(some), export)
        fill_layers(spark, export, f"{path}/layers", prefix)
    return prefix


def silver_increments(spark, sf_dir):
    return spark.table(f"{_incremented(spark, sf_dir)}silver.events_cleaned").select(*_by_user(spark, sf_dir).columns)


def gold_increments(spark, sf_dir):
    prefix = _incremented(spark, sf_dir)
    tables = []
    for name in ("events_metrics", "events_by_type"):
        table = _rounded(spark.table(f"{prefix}gold.{name}"))
        tables.append(table.withColumn("event_date", F.lit(None).cast("date")).withColumn("name", F.lit(name)))
    for name in ("events_metrics_by_date", "events_by_type_and_date"):
        tables.append(_rounded(spark.table(f"{prefix}gold.{name}")).withColumn("name", F.lit(name)))
    columns = ["name", "event_type", "event_date", "total_events", "avg_value", "min_value", "max_value"]
    return reduce(DataFrame.unionByName, [table.select(columns) for table in tables])


def gold_metrics(spark, sf_dir):
    return _rounded(layers.gold_metrics(_events(spark, sf_dir))).drop("calculated_at")


def gold_by_type_date(spark, sf_dir):
    return _rounded(layers.gold_by_type_and_date(_events(spark, sf_dir))).drop("calculated_at")


def gold_view(spark, sf_dir):
    layers.silver_events(_by_user(spark, sf_dir)).createOrReplaceTempView("silver_by_user")
    per_type, _ = layers.create_gold_views(spark, "silver_by_user")
    return _rounded(spark.table(per_type))


def gold_view_by_day(spark, sf_dir):
    layers.silver_events(_by_user(spark, sf_dir)).createOrReplaceTempView("silver_by_user")
    _, per_day = layers.create_gold_views(spark, "silver_by_user")
    return spark.table(per_day).drop("avg_value")


def first_rows(spark, sf_dir):
    return profile.sample_rows(_table(spark, sf_dir, "orders").orderBy("o_orderkey"), 10).select("o_orderkey", "o_totalprice")


def schema_listing(spark, sf_dir):
    return profile.schema_rows(_table(spark, sf_dir, "lineitem")).select("name", "type")


def table_inventory(spark, sf_dir):
    export = new_path(spark, "export")
    prefix = f"inv_{export[-32:]}_"
    write_by_date(_by_user(spark, sf_dir), export)
    listed = fill_layers(spark, export, new_path(spark, "layers"), prefix).collect()
    counted = [
        profile.row_count(spark.table(f"{r.schema_name}.{r.table_name}")).select(
            F.lit(r.table_name).alias("table_name"),
            F.lit(r.schema_name.removeprefix(prefix)).alias("schema_name"),
            F.lit(r.table_type).alias("table_type"),
            "total_rows",
        )
        for r in listed
    ]
    return reduce(DataFrame.unionByName, counted)


def flow_gold(spark, sf_dir):
    topic, root = new_path(spark, "topic"), new_path(spark, "flow")
    publish_files(_test_events(spark, sf_dir), topic, F.pmod("id", F.lit(4)), F.col("id"))
    prefix = f"flow_{root[-32:]}_"
    schema = with_types(WIDE_EVENT, value=T.LongType())
    run_flow(spark, MessageFiles(topic), root, schema=schema, layer_prefix=prefix)
    return _rounded(spark.table(f"{prefix}gold.events_metrics")).drop("calculated_at")


_QUERIES = (
    row_count,
    dataset_stats,
    numeric_profile,
    exact_extremes,
    type_frequency,
    top_values,
    dq_measured,
    rows_per_date,
    first_dates,
    max_string_length,
    partition_skew,
    duplicate_count,
    dq_schema,
    dq_nulls,
    dq_duplicates,
    dq_ranges,
    dq_data_types,
    dq_anomalies,
    dq_infinite,
    dq_distribution,
    dq_encoding,
    dq_custom,
    dq_broken_rule,
    dq_run,
    dq_increments,
    dq_findings,
    dq_report,
    dq_export_suite,
    lake_checks,
    validation_report,
    generate_events,
    decode_bytes,
    parse_events,
    encode_events,
    ingestion_date,
    partitioned_export,
    plain_export,
    published_messages,
    ingest_stamp,
    gated_exports,
    external_table,
    delete_where,
    delete_counts,
    delete_partitions,
    delete_preview,
    stream_ingest,
    stream_check,
    live_checks,
    incremental_files,
    bronze_reload,
    silver_clean,
    silver_increments,
    gold_increments,
    gold_metrics,
    gold_by_type_date,
    gold_view,
    gold_view_by_day,
    first_rows,
    schema_listing,
    table_inventory,
    flow_gold,
    schema_growth,
)


def _optional(name: str) -> ModuleType | None:
    """A module that may have been left out, the only one whose absence is no error."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if not f"{name}.".startswith(f"{error.name}."):
            raise
        return None


# What prepares training text comes as a subpackage of its own.
_TEXT = _optional("siftlake.llm.queries")
_PIPELINE = _TEXT and _optional("corpus_pipeline")


def _with_work_dir(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A local session without a shared folder gets one; on a cluster the session must name it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_local_root(spark)
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """All ten checks on the smallest events table."""
    return queries()["dq_run"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if _TEXT:
        found |= _TEXT.queries()
    if _PIPELINE:
        found["pipeline"] = _PIPELINE.run
    return {name: _with_work_dir(query) for name, query in found.items()}


# --- the same in SQL -----------------------------------------------------------------------------------------------

_SQL_EVENTS = """
    e AS (SELECT event_id AS id, value, event_type AS type, epoch_us(ts) // 1000 AS "timestamp",
                 CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, ts AS ingested_at,
                 CAST(ts AS DATE) AS ingestion_date
          FROM events)"""
_SQL_FLAWED = _SQL_EVENTS.replace("event_type AS type", "nullif(event_type, 'error') AS type")
_SQL_BY_USER = """
    u AS (SELECT user_id AS id, value, nullif(event_type, 'error') AS type, epoch_us(ts) // 1000 AS "timestamp",
                 CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, ts AS ingested_at
          FROM events)"""
_SQL_BANDED = """
    b AS (SELECT CASE WHEN value < 20 THEN -1 ELSE CAST(floor(value) AS BIGINT) END AS band FROM events)"""
_SQL_SILVER = """
    s AS (SELECT * FROM u WHERE id IS NOT NULL AND value IS NOT NULL AND type IS NOT NULL AND "timestamp" IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC, kafka_offset DESC) = 1)"""
_SQL_MESSAGE = """concat('{"id":', id, ',"value":', CAST(trunc(value) AS INTEGER), ',"type":"', type, '","timestamp":',
    "timestamp", '}')"""
_METRICS = """CAST(count(*) AS BIGINT) AS total_events, round(avg(value), 6) AS avg_value, min(value) AS min_value,
    max(value) AS max_value"""


def _sql_profile(table: str, columns: list[str], integral: tuple = ()) -> str:
    exact, none = "CAST({f} AS VARCHAR)", "CAST(NULL AS VARCHAR)"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"round(avg({c}), 6) AS avg, round(stddev_samp({c}), 6) AS stddev, count({c}) AS count, "
        f"CAST(0 AS BIGINT) AS nan_count, {exact.format(f=f'min({c})') if c in integral else none} AS min_exact, "
        f"{exact.format(f=f'max({c})') if c in integral else none} AS max_exact FROM {table}"
        for c in columns
    )


def _sql_result(check: str, status: str, violations: str, detail: str, deduction: str, source: str = "") -> str:
    """One result row as SQL; all but the check name are SQL expressions."""
    return (
        f"SELECT '{check}' AS \"check\", {status} AS status, CAST({violations} AS BIGINT) AS violations, "
        f"{detail} AS detail, CAST({deduction} AS INTEGER) AS deduction {source}"
    )


def _sql_flag(n: str, bad: str, points: int, bad_detail: str, good_detail: str) -> tuple[str, str, str]:
    """Status, detail and deduction of a check with a single count."""
    return (
        f"CASE WHEN {n} > 0 THEN '{bad}' ELSE 'PASS' END",
        f"CASE WHEN {n} > 0 THEN {bad_detail} ELSE {good_detail} END",
        f"CASE WHEN {n} > 0 THEN {points} ELSE 0 END",
    )


def _sql_run(ranges: dict[str, tuple], kinds: tuple, expected_missing: str = "") -> tuple[str, str]:
    """Measures (CTEs over ``e``) and the ten result rows of the event suite."""
    measured = ("id", "value", "timestamp", "kafka_partition", "kafka_offset")
    spread = ", ".join(f'avg("{c}") AS a_{c}, stddev_samp("{c}") AS s_{c}' for c in measured)
    outside = ", ".join(
        f'count(*) FILTER (WHERE "{c}" > a_{c} + 3 * s_{c} OR "{c}" < a_{c} - 3 * s_{c}) AS o_{c}' for c in measured
    )
    nulls = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS n_{c}' for c in CRITICAL_COLUMNS)
    limits = ", ".join(
        f'count(*) FILTER (WHERE "{c}" < {lo} OR "{c}" > {hi}) AS r_{c}' for c, (lo, hi) in ranges.items()
    )
    listed = ", ".join(f"'{k}'" for k in kinds)
    ctes = f"""
    m AS (SELECT count(*) AS n, {nulls}, {limits},
                 count(*) FILTER (WHERE length(type) > 1000000) AS long_type,
                 count(*) FILTER (WHERE contains(type, chr(65533))) AS bad_type,
                 count(*) FILTER (WHERE type IS NULL OR type NOT IN ({listed})) AS c_kind,
                 count(*) FILTER (WHERE value < 0) AS c_negative FROM e),
    k AS (SELECT (SELECT count(*) FROM e) - (SELECT count(*) FROM (SELECT DISTINCT id, "timestamp" FROM e)) AS dup),
    p AS (SELECT max(c) > 10 * avg(c) AS skewed FROM (SELECT count(*) AS c FROM e GROUP BY ingestion_date)),
    st AS (SELECT {spread} FROM e),
    o AS (SELECT {outside} FROM e, st)"""
    count_bad = lambda prefix, names: " + ".join(f"CAST({prefix}_{c} > 0 AS INTEGER)" for c in names)
    total = lambda prefix, names: " + ".join(f"{prefix}_{c}" for c in names)
    null_list = ", ".join(
        f"CASE WHEN n_{c} > 0 THEN concat('{c}(', n_{c}, ')') END" for c in CRITICAL_COLUMNS
    )
    n_null, n_range, n_out = (
        count_bad("n", CRITICAL_COLUMNS),
        count_bad("r", ranges),
        count_bad("o", measured),
    )
    n_rules = "CAST(c_kind > 0 AS INTEGER) + CAST(c_negative > 0 AS INTEGER)"

    def several(check, number, violations, bad, points, bad_detail, good_detail, source):
        status = f"CASE WHEN {number} > 0 THEN '{bad}' ELSE 'PASS' END"
        detail = f"CASE WHEN {number} > 0 THEN {bad_detail} ELSE '{good_detail}' END"
        return _sql_result(check, status, violations, detail, f"({number}) * {points}", f"FROM {source}")

    rows = [
        _sql_result("row_count", "CASE WHEN n < 1 THEN 'FAIL' ELSE 'PASS' END", "CAST(n < 1 AS INTEGER)",
                    "concat(n, ' rows')", "CASE WHEN n < 1 THEN 30 ELSE 0 END", "FROM m"),
        _sql_result("schema", "'PASS'", "0", "'8 columns'", "0"),
        several("nulls", n_null, total("n", CRITICAL_COLUMNS), "FAIL", 10,
                f"concat_ws(', ', {null_list})", "no nulls", "m"),
        several("duplicates", "CAST(dup > 0 AS INTEGER)", "dup", "WARN", 10, "concat(dup, ' duplicates')",
                "0 duplicates", "k"),
        several("ranges", n_range, total("r", ranges), "WARN", 10,
                f"concat({n_range}, ' columns out of range')", "all in range", "m"),
        several("data_types", "CAST(long_type > 0 AS INTEGER)", "long_type", "WARN", 0, "'1 type issues'",
                "all types valid", "m"),
        several("anomalies", n_out, total("o", measured), "WARN", 0, f"concat('outliers in ', {n_out}, ' cols')",
                "no outliers", "o"),
        several("distribution", "CAST(skewed AS INTEGER)", "CAST(skewed AS INTEGER)", "WARN", 5,
                "'data skew detected'", "balanced", "p"),
        several("encoding", "CAST(bad_type > 0 AS INTEGER)", "bad_type", "WARN", 5, "'1 cols with issues'",
                "consistent", "m"),
        several("custom", n_rules, "c_kind + c_negative", "FAIL", 10, f"concat({n_rules}, ' rules failed')",
                "all rules passed", "m"),
    ]
    return ctes, " UNION ALL ".join(rows)


_RANGES = {"value": (0, 100), "timestamp": (0, 9_999_999_999_999)}
_REPORT = """SELECT count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'WARN') AS warned,
    count(*) FILTER (WHERE status = 'FAIL') AS failed,
    CAST(greatest(0, 100 - sum(deduction)) AS INTEGER) AS quality_score,
    greatest(0, 100 - sum(deduction)) >= 70 AND count(*) FILTER (WHERE status = 'FAIL') = 0 AS can_upload"""


def _sql_findings() -> str:
    ctes, _ = _sql_run(_RANGES, KINDS)
    found = [("row_count", "*", "CAST(n < 1 AS INTEGER)", 30, "m")]
    found += [("nulls", c, f"n_{c}", 10, "m") for c in CRITICAL_COLUMNS]
    found += [("duplicates", "id, timestamp", "dup", 10, "k")]
    found += [("ranges", c, f"r_{c}", 10, "m") for c in _RANGES]
    found += [("data_types", "type", "long_type", 0, "m")]
    found += [
        ("anomalies", c, f"o_{c}", 0, "o") for c in ("id", "value", "timestamp", "kafka_partition", "kafka_offset")
    ]
    found += [("distribution", "ingestion_date", "CAST(skewed AS INTEGER)", 5, "p")]
    found += [("encoding", "type", "bad_type", 5, "m")]
    found += [("custom", "event_type_valid", "c_kind", 10, "m"), ("custom", "value_not_negative", "c_negative", 10, "m")]
    rows = " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", CAST({n} AS BIGINT) AS violations, "
        f"CAST(CASE WHEN {n} > 0 THEN {points} ELSE 0 END AS INTEGER) AS deduction FROM {source}"
        for check, column, n, points, source in found
    )
    return f"WITH {_SQL_FLAWED}, {ctes} {rows}"


def _sql_report() -> str:
    ctes, rows = _sql_run(_RANGES, KINDS)
    one = lambda events, name: (
        f"SELECT *, '{name}' AS dataset FROM (WITH {events}, {ctes} {_REPORT} FROM ({rows}))"
    )
    return f"{one(_SQL_FLAWED, 'flawed')} UNION ALL {one(_SQL_EVENTS, 'intact')}"


def _sql_gated() -> str:
    return (
        "SELECT dataset, quality_score, can_upload, can_upload AS exported, "
        "CASE WHEN can_upload THEN (SELECT count(*) FROM events) ELSE 0 END AS rows_written "
        f"FROM ({_sql_report()})"
    )


def _sql_export_suite() -> str:
    sent = """
    e AS (SELECT event_id AS id, event_id * 10 AS value, 'test_event' AS type, epoch_us(ts) // 1000 AS "timestamp",
                 CAST(event_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
                 CAST(ts AS DATE) AS ingestion_date FROM events)"""
    ctes, rows = _sql_run(
        {"value": (0, 1_000_000), "timestamp": (0, 9_999_999_999_999)}, ("test_event", "production_event", "debug_event")
    )
    return f"WITH {sent}, {ctes} {rows}"


def _sql_single(check: str, n: str, bad: str, points: int, bad_detail: str, good_detail: str, source: str) -> str:
    status, detail, deduction = _sql_flag(n, bad, points, bad_detail, good_detail)
    return _sql_result(check, status, n, detail, deduction, source)


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    if _TEXT:
        found |= _TEXT.oracle_sql()
    if _PIPELINE and _PIPELINE.ORACLE_SQL:
        found["pipeline"] = _PIPELINE.ORACLE_SQL
    return found


def _own_sql() -> dict[str, str]:
    ctes, run = _sql_run(_RANGES, KINDS)
    lineitem_numbers = [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    ]
    strings = [("documents", c) for c in ("text", "lang", "source")]
    strings += [("pages", c) for c in ("url", "html")] + [("conversations", c) for c in ("role", "text")]
    export = 'SELECT id, value, type, "timestamp", ingestion_date FROM e'
    segments = ", ".join(f"'{s}'" for s in SEGMENTS)
    non_ascii = r"[^\x00-\x7F]"
    doomed = "coalesce(type <> 'view' AND value > 20, false)"
    some = "(ingestion_date < DATE '2024-01-08' OR (ingestion_date = DATE '2024-01-10' AND type = 'click'))"
    return {
        "row_count": "SELECT count(*) AS total_rows FROM lineitem",
        "dataset_stats": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS total_rows, "
            f"(SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE {t})) AS schema_columns"
            for t in TABLES
        ),
        "numeric_profile": _sql_profile("lineitem", lineitem_numbers, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
        "exact_extremes": f"SELECT 'wide_id' AS \"column\", CAST(min(event_id) + {_BEYOND_DOUBLE} AS VARCHAR) AS min_exact, "
        f"CAST(max(event_id) + {_BEYOND_DOUBLE} AS VARCHAR) AS max_exact, count(*) AS count FROM events",
        "dq_infinite": "WITH d AS (SELECT count(*) FILTER (WHERE event_id % 100 IN (8, 9)) AS n FROM events) "
        + _sql_single("anomalies", "n", "WARN", 0, "'outliers in 1 cols'", "'no outliers'", "FROM d"),
        "dq_broken_rule": "SELECT 'row_count' AS \"check\", 'PASS' AS status, CAST(0 AS INTEGER) AS deduction "
        "UNION ALL SELECT 'custom', 'FAIL', CAST(10 * CAST(count(*) FILTER (WHERE value < 0) > 0 AS INTEGER) AS INTEGER) FROM events",
        "schema_growth": f"WITH {_SQL_EVENTS} SELECT id, CASE WHEN id % 2 = 1 THEN concat('n', id) END AS note FROM e "
        "WHERE value IS NOT NULL AND type IS NOT NULL",
        "type_frequency": "SELECT event_type AS type, count(*) AS count FROM events GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 20",
        "top_values": """(SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20)
            UNION ALL (SELECT user_id, count(*) FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)""",
        "dq_measured": f"""WITH {_SQL_FLAWED}, d AS (SELECT count(*) AS c FROM e GROUP BY ingestion_date),
            g AS (SELECT count(*) AS n, min(c) AS low, max(c) AS high, avg(c) AS mean FROM d),
            m AS (SELECT 'partitions' AS measure, CAST(n AS DOUBLE) AS value FROM g UNION ALL SELECT 'min_rows', low FROM g
                UNION ALL SELECT 'max_rows', high FROM g UNION ALL SELECT 'avg_rows', mean FROM g
                UNION ALL SELECT 'ratio', high / mean FROM g)
            SELECT 'distribution' AS "check", 'ingestion_date' AS "column", measure, round(value, 6) AS value FROM m
            UNION ALL VALUES ('schema', 'lost', 'missing', 1), ('schema', 'ingestion_date', 'extra', 1),
                ('schema', 'type', 'extra', 1)""",
        "rows_per_date": "SELECT CAST(ts AS DATE) AS ingestion_date, count(*) AS count FROM events GROUP BY 1",
        "first_dates": "SELECT CAST(ts AS DATE) AS ingestion_date, count(*) AS count FROM events GROUP BY 1 "
        "ORDER BY 1 LIMIT 10",
        "max_string_length": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS \"column\", "
            f"CAST(max(coalesce(length({c}), 0)) AS INTEGER) AS max_length FROM {t}"
            for t, c in strings
        ),
        "partition_skew": f"WITH {_SQL_BANDED} SELECT count(*) AS partitions, min(c) AS min_rows, max(c) AS max_rows, "
        "round(avg(c), 6) AS avg_rows, max(c) > 10 * avg(c) AS skewed "
        "FROM (SELECT count(*) AS c FROM b GROUP BY band)",
        "duplicate_count": f"""WITH {_SQL_BY_USER},
            t AS (SELECT count(*) AS c FROM documents GROUP BY text), p AS (SELECT count(*) AS c FROM u GROUP BY id, type)
            SELECT 'text' AS key, CAST(sum(c) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
                   CAST(sum(c - 1) AS BIGINT) AS duplicates FROM t
            UNION ALL SELECT 'user, type', CAST(sum(c) AS BIGINT), count(*), CAST(sum(c - 1) AS BIGINT) FROM p""",
        "dq_schema": _sql_result(
            "row_count", "CASE WHEN count(*) < 1 THEN 'FAIL' ELSE 'PASS' END", "CAST(count(*) < 1 AS INTEGER)",
            "concat(count(*), ' rows')", "CASE WHEN count(*) < 1 THEN 30 ELSE 0 END", "FROM events",
        ) + """ UNION ALL SELECT 'schema', 'INCOMPLETE', count(*),
            concat('missing ', string_agg(name, ', ' ORDER BY name)), 25
            FROM (VALUES ('id'), ('value'), ('type'), ('timestamp'), ('ingested_at'), ('kafka_partition'),
                  ('kafka_offset')) AS wanted(name)
            WHERE name NOT IN (SELECT column_name FROM (DESCRIBE events))""",
        "dq_nulls": f"WITH {_SQL_FLAWED}, {ctes} SELECT * FROM ({run}) WHERE \"check\" = 'nulls'",
        "dq_duplicates": f"WITH {_SQL_BY_USER}, d AS (SELECT (SELECT count(*) FROM u) - "
        "(SELECT count(*) FROM (SELECT DISTINCT id, type FROM u)) AS n) "
        + _sql_single("duplicates", "n", "WARN", 10, "concat(n, ' duplicates')", "'0 duplicates'", "FROM d"),
        "dq_ranges": f"""WITH {_SQL_EVENTS},
            r AS (SELECT count(*) FILTER (WHERE value < 0 OR value > 100) AS a,
                         count(*) FILTER (WHERE kafka_partition < 0 OR kafka_partition > 3) AS b,
                         count(*) FILTER (WHERE "timestamp" < 1704412800000 OR "timestamp" > 9999999999999) AS c FROM e),
            f AS (SELECT *, CAST(a > 0 AS INTEGER) + CAST(b > 0 AS INTEGER) + CAST(c > 0 AS INTEGER) AS k FROM r) """
        + _sql_result(
            "ranges", "CASE WHEN k > 0 THEN 'WARN' ELSE 'PASS' END", "a + b + c",
            "CASE WHEN k > 0 THEN concat(k, ' columns out of range') ELSE 'all in range' END", "10 * k", "FROM f",
        ),
        "dq_data_types": """WITH r AS (SELECT count(*) FILTER (WHERE length(text) > 20000) AS a,
                count(*) FILTER (WHERE length(lang) > 20000) AS b,
                count(*) FILTER (WHERE length(source) > 20000) AS c FROM documents),
            f AS (SELECT *, CAST(a > 0 AS INTEGER) + CAST(b > 0 AS INTEGER) + CAST(c > 0 AS INTEGER) AS k FROM r) """
        + _sql_result(
            "data_types", "CASE WHEN k > 0 THEN 'WARN' ELSE 'PASS' END", "a + b + c",
            "CASE WHEN k > 0 THEN concat(k, ' type issues') ELSE 'all types valid' END", "0", "FROM f",
        ),
        "dq_anomalies": f"WITH {_SQL_EVENTS}, {ctes} SELECT * FROM ({run}) WHERE \"check\" = 'anomalies'",
        "dq_distribution": f"WITH {_SQL_BANDED}, d AS (SELECT CAST(max(c) > 10 * avg(c) AS INTEGER) AS n "
        "FROM (SELECT count(*) AS c FROM b GROUP BY band)) "
        + _sql_single("distribution", "n", "WARN", 5, "'data skew detected'", "'balanced'", "FROM d"),
        "dq_encoding": f"WITH d AS (SELECT count(*) FILTER (WHERE regexp_matches(text, '{non_ascii}')) AS n "
        "FROM documents) "
        + _sql_single("encoding", "n", "WARN", 5, "'1 cols with issues'", "'consistent'", "FROM d"),
        "dq_custom": f"""WITH r AS (SELECT count(*) FILTER (WHERE c_acctbal < 0) AS a,
                count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ({segments})) AS b,
                count(*) FILTER (WHERE c_name IS NULL OR c_name = '') AS c FROM customer),
            f AS (SELECT *, CAST(a > 0 AS INTEGER) + CAST(b > 0 AS INTEGER) + CAST(c > 0 AS INTEGER) AS k FROM r) """
        + _sql_result(
            "custom", "CASE WHEN k > 0 THEN 'FAIL' ELSE 'PASS' END", "a + b + c",
            "CASE WHEN k > 0 THEN concat(k, ' rules failed') ELSE 'all rules passed' END", "10 * k", "FROM f",
        ),
        "dq_run": f"WITH {_SQL_FLAWED}, {ctes} {run}",
        "dq_increments": f"WITH {_SQL_FLAWED}, {ctes} {run}",
        "dq_findings": _sql_findings(),
        "dq_report": _sql_report(),
        "dq_export_suite": _sql_export_suite(),
        "lake_checks": f"""WITH {_SQL_FLAWED}, {ctes},
            d AS (SELECT (SELECT count(*) FROM e) - (SELECT count(DISTINCT id) FROM e) AS n)
            SELECT * FROM ({run}) WHERE "check" = 'nulls' UNION ALL """
        + _sql_single("duplicates", "n", "WARN", 10, "concat(n, ' duplicates')", "'0 duplicates'", "FROM d"),
        "validation_report": f"""WITH {_SQL_FLAWED}, {ctes},
            d AS (SELECT (SELECT count(*) FROM e) - (SELECT count(DISTINCT id) FROM e) AS n),
            q AS (SELECT * FROM ({run}) WHERE "check" = 'nulls' UNION ALL """
        + _sql_single("duplicates", "n", "WARN", 10, "concat(n, ' duplicates')", "'0 duplicates'", "FROM d")
        + """),
            a AS (SELECT column_name AS name FROM (DESCRIBE SELECT * FROM e)),
            w(name) AS (VALUES ('id'), ('value'), ('type'), ('timestamp'), ('ingested_at')),
            added AS (SELECT name FROM a WHERE name <> 'ingestion_date' AND name NOT IN (SELECT name FROM w)),
            lost AS (SELECT name FROM w WHERE name NOT IN (SELECT name FROM a)),
            v AS (SELECT (SELECT count(*) FROM added) AS n_added, (SELECT count(*) FROM lost) AS n_lost),
            f AS (SELECT bool_or(status IN ('FAIL', 'ERROR')) AS failed, CAST(sum(violations) AS BIGINT) AS violations,
                         coalesce(string_agg(concat("check", ': ', status, ': ', detail), '; ' ORDER BY "check" DESC)
                                  FILTER (WHERE violations > 0), '') AS detail FROM q),
            n AS (SELECT count(*) AS total_rows, CAST((SELECT count(*) FROM a) AS INTEGER) AS schema_columns,
                         least(10, count(DISTINCT ingestion_date)) AS dates FROM e),
            t AS (SELECT 'flawed' AS dataset, 'quality_checks' AS "check", CASE WHEN failed THEN 'FAILED' ELSE 'PASSED' END AS result,
                         CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END AS status, violations, detail FROM f
                  UNION ALL SELECT 'intact', 'quality_checks', 'PASSED', 'PASS', 0, ''
                  UNION ALL SELECT dataset, 'schema_evolution',
                      CASE WHEN n_added > 0 THEN 'EVOLVED' WHEN n_lost > 0 THEN 'INCOMPLETE' ELSE 'PASSED' END,
                      CASE WHEN n_added + n_lost > 0 THEN 'WARN' ELSE 'PASS' END, n_added + n_lost,
                      concat_ws('; ', (SELECT 'missing: ' || string_agg(name, ', ' ORDER BY name) FROM lost),
                                (SELECT 'new: ' || string_agg(name, ', ' ORDER BY name) FROM added))
                  FROM v, (VALUES ('flawed'), ('intact')) x(dataset))
            SELECT t.*, n.* FROM t, n""",
        "generate_events": "SELECT event_id AS id, event_id * 10 AS value, 'test_event' AS type, "
        'epoch_us(ts) // 1000 AS "timestamp" FROM events',
        "decode_bytes": f"""WITH t AS (SELECT doc_id, text, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes,
                CAST(length(text) AS INTEGER) AS n_chars,
                CAST(length(regexp_replace(text, '{non_ascii}', '', 'g')) AS INTEGER) AS n_ascii FROM documents)
            SELECT doc_id, c.charset,
                   CASE WHEN c.charset LIKE 'utf%' THEN n_chars ELSE n_bytes END AS n_chars,
                   CASE WHEN c.charset = 'ascii' THEN n_bytes - n_ascii ELSE 0 END AS n_replaced,
                   CASE WHEN c.charset LIKE 'utf%' THEN md5(text) END AS digest
            FROM t, (VALUES ('utf-8'), ('utf-8-sig'), ('latin-1'), ('ascii')) AS c(charset)""",
        "parse_events": f"""WITH {_SQL_FLAWED} SELECT CASE WHEN type IS NOT NULL THEN id END AS id,
            CASE WHEN type IS NOT NULL THEN CAST(trunc(value) AS INTEGER) END AS value, type,
            CASE WHEN type IS NOT NULL THEN "timestamp" END AS "timestamp", kafka_partition, kafka_offset FROM e""",
        "encode_events": f"""WITH {_SQL_EVENTS}, j AS (SELECT id, {_SQL_MESSAGE} AS message FROM e)
            SELECT id, message, CAST(length(message) AS INTEGER) AS n_bytes FROM j""",
        "ingestion_date": f"WITH {_SQL_EVENTS} SELECT id, ingestion_date FROM e",
        "partitioned_export": f"WITH {_SQL_EVENTS} {export}",
        "plain_export": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
        "published_messages": f"""WITH {_SQL_EVENTS} SELECT kafka_partition, kafka_offset, {_SQL_MESSAGE} AS text
            FROM e""",
        "ingest_stamp": "SELECT count(*) AS total_rows, CAST(least(count(*), 1) AS BIGINT) AS stamps FROM events",
        "gated_exports": _sql_gated(),
        "external_table": f"WITH {_SQL_EVENTS} SELECT id, value, type, kafka_partition, kafka_offset, ingestion_date "
        "FROM e",
        "delete_where": f"WITH {_SQL_FLAWED} SELECT id, value, type FROM e WHERE NOT {doomed}",
        "delete_counts": f"""WITH {_SQL_FLAWED}, g AS (SELECT count(*) AS n,
                count(*) FILTER (WHERE coalesce({some}, false)) AS gone FROM e)
            SELECT CAST(1 AS INTEGER) AS step, n AS total_rows, gone AS deleted_rows, n - gone AS remaining_rows FROM g
            UNION ALL SELECT 2, n - gone, n - gone, 0 FROM g""",
        "delete_partitions": f"WITH {_SQL_FLAWED} SELECT id, value FROM e WHERE id % 60 >= 40 "
        "AND NOT coalesce(id % 60 % 7 = 3 AND value > 20, false)",
        "delete_preview": f"WITH {_SQL_FLAWED} SELECT count(*) AS total_rows, "
        f"count(*) FILTER (WHERE {doomed}) AS rows_to_delete FROM e",
        "stream_ingest": f'WITH {_SQL_EVENTS} SELECT id, CAST(trunc(value) AS INTEGER) AS value, type, "timestamp", '
        "kafka_partition, kafka_offset FROM e",
        "stream_check": f"""WITH {_SQL_FLAWED}, n AS (SELECT count(*) AS total_rows,
                count(*) FILTER (WHERE type IS NULL) AS lost FROM e)
            SELECT 'nulls' AS "check", CASE WHEN lost > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
                4 * lost AS violations,
                CASE WHEN lost > 0 THEN format('id({{}}), value({{}}), type({{}}), timestamp({{}})', lost, lost, lost, lost)
                     ELSE 'no nulls' END AS detail,
                CAST(CASE WHEN lost > 0 THEN 40 ELSE 0 END AS INTEGER) AS deduction, total_rows FROM n""",
        "live_checks": f"""WITH {_SQL_FLAWED}, n AS (SELECT count(*) AS "rows", count(*) FILTER (WHERE type IS NULL) AS lost
                FROM e)
            SELECT "rows", lost AS missing_id, lost AS missing_value, lost AS missing_type, lost AS missing_timestamp FROM n""",
        "incremental_files": f"WITH {_SQL_EVENTS} {export}",
        "bronze_reload": f"WITH {_SQL_EVENTS} SELECT id, value, type, ingestion_date, "
        "CASE WHEN ingestion_date = DATE '2024-01-06' THEN id % 7 END AS note FROM e WHERE ingestion_date >= DATE '2024-01-05'",
        "silver_clean": f"WITH {_SQL_BY_USER}, {_SQL_SILVER} SELECT * FROM s",
        "silver_increments": f"WITH {_SQL_BY_USER}, {_SQL_SILVER} SELECT * FROM s",
        "gold_increments": f"""WITH {_SQL_BY_USER}, {_SQL_SILVER},
            t AS (SELECT type AS event_type, CAST(NULL AS DATE) AS event_date, {_METRICS} FROM s GROUP BY type),
            d AS (SELECT type AS event_type, CAST(ingested_at AS DATE) AS event_date, {_METRICS} FROM s GROUP BY ALL)
            SELECT 'events_metrics' AS name, * FROM t UNION ALL SELECT 'events_by_type', * FROM t
            UNION ALL SELECT 'events_metrics_by_date', * FROM d UNION ALL SELECT 'events_by_type_and_date', * FROM d""",
        "gold_metrics": f"WITH {_SQL_EVENTS} SELECT type AS event_type, {_METRICS} FROM e GROUP BY type",
        "gold_by_type_date": f"WITH {_SQL_EVENTS} SELECT type AS event_type, ingestion_date AS event_date, {_METRICS} "
        "FROM e GROUP BY ALL",
        "gold_view": f"WITH {_SQL_BY_USER}, {_SQL_SILVER} SELECT type AS event_type, {_METRICS} FROM s GROUP BY type",
        "gold_view_by_day": f"""WITH {_SQL_BY_USER}, {_SQL_SILVER} SELECT type AS event_type,
            CAST(ingested_at AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS total_events, min(value) AS min_value,
            max(value) AS max_value FROM s GROUP BY ALL""",
        "first_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
        "schema_listing": """SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
            WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type
            FROM (DESCRIBE lineitem)""",
        "table_inventory": f"""WITH {_SQL_BY_USER}, {_SQL_SILVER}
            SELECT 'events_raw' AS table_name, 'bronze' AS schema_name, 'EXTERNAL' AS table_type,
                   (SELECT count(*) FROM u) AS total_rows
            UNION ALL SELECT 'events_cleaned', 'silver', 'MANAGED', (SELECT count(*) FROM s)
            UNION ALL SELECT t.name, 'gold', t.kind, CASE WHEN t.daily THEN
                (SELECT count(*) FROM (SELECT DISTINCT type, CAST(ingested_at AS DATE) FROM s))
                ELSE (SELECT count(DISTINCT type) FROM s) END
            FROM (VALUES ('events_metrics', 'MANAGED', false), ('events_by_type', 'VIEW', false),
                ('events_metrics_by_date', 'MANAGED', true), ('events_by_type_and_date', 'VIEW', true)) t(name, kind, daily)""",
        "flow_gold": """SELECT 'test_event' AS event_type, count(*) AS total_events,
            round(avg(10 * event_id), 6) AS avg_value, min(10 * event_id) AS min_value, max(10 * event_id) AS max_value
            FROM events""",
    }
