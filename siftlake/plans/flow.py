"""All stages in order on one session: messages, raw table, gated export, validation, bronze, silver, gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siftlake import catalog
from siftlake.operators.layers import create_gold_views, silver_events
from siftlake.plans.export import Export, gated_export
from siftlake.plans.increments import BUCKETS, PARTS, Increments, gold_from_states, gold_states
from siftlake.plans.lake_validation import validation_report
from siftlake.schemas import EVENT_SCHEMA
from siftlake.sources.messages import MessageSource
from siftlake.sources.schema_log import SchemaLog
from siftlake.sources.tables import read_path
from siftlake.streaming.bronze import FILE, each_new_batch
from siftlake.streaming.ingest import IngestCheck, ingest_events
from siftlake.workspace import remove

_BY_TYPE = ("event_type",)
_BY_TYPE_AND_DATE = ("event_type", "event_date")


@dataclass(frozen=True)
class Flow:
    """What each stage found; later stages are None when an earlier one stopped the flow."""

    ingest: IngestCheck
    export: Export | None = None
    validation: DataFrame | None = None
    tables: DataFrame | None = None


def run_flow(
    spark: SparkSession,
    source: MessageSource,
    root: str,
    schema: T.StructType = EVENT_SCHEMA,
    layer_prefix: str = "",
) -> Flow:
    """Stop after ingest when no row arrived, and after the checks when the gate is closed."""
    raw, export = f"{root}/raw", f"{root}/export"
    ingest = ingest_events(spark, source, raw, f"{root}/checkpoints/raw", schema=schema)
    if not ingest.succeeded:
        return Flow(ingest)
    exported = gated_export(read_path(spark, raw, merge_schema=True), export)
    if not exported.exported:
        return Flow(ingest, exported)
    validation = validation_report(read_path(spark, export, merge_schema=True))
    return Flow(ingest, exported, validation, fill_layers(spark, export, f"{root}/layers", layer_prefix))


def fill_layers(
    spark: SparkSession,
    export: str,
    location: str,
    prefix: str = "",
    rebuild: bool = False,
    parts: int = PARTS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Register the export as bronze, bring silver and both gold tables up to its new files, create the views over silver,
    and list the tables.

    A call reads the files that are new since the last one. Rows that left the export stay in silver, and a later row of
    an id replaces an earlier one; ``rebuild`` fills everything from the whole export.
    """
    bronze_name, silver_name, gold_name = names = catalog.create_layers(spark, prefix, location)
    log, at = SchemaLog.beside(spark, export), f"{location}/{prefix}increments"
    known = log.of_dataset(export)
    if rebuild:
        spark.sql(f"DROP TABLE IF EXISTS {silver_name}.{catalog.SILVER_TABLE}")
        remove(spark, at)

    def silver_schema(columns: T.StructType) -> T.StructType:
        return silver_events(spark.createDataFrame([], columns)).schema

    silver = catalog.create_silver_table(spark, silver_name, silver_schema(known), buckets=buckets)
    increments = Increments(spark, silver, at, parts, buckets)

    def take(rows: DataFrame, number: int, columns: T.StructType) -> None:
        catalog.add_columns(spark, silver, silver_schema(columns))
        # The batch has a session of its own; only its rows are taken from there.
        increments.take(rows.drop(FILE), number)

    each_new_batch(spark, export, f"{at}/checkpoint", take)
    catalog.create_bronze_table(spark, bronze_name, export, log.of_dataset(export))
    states = increments.states()
    if states is None:
        states = gold_states(spark.table(silver))
    for table, by in ((catalog.GOLD_TABLE, _BY_TYPE), (catalog.GOLD_DAILY_TABLE, _BY_TYPE_AND_DATE)):
        gold = gold_from_states(states, *by)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in gold.schema)
        catalog.refill(gold, catalog.create_gold_table(spark, gold_name, columns, table=table))
    create_gold_views(spark, silver, gold_name)
    return catalog.table_inventory(spark, names)
