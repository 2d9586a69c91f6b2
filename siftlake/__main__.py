"""Command line, one subcommand per job: ``spark-submit ... -m siftlake`` or ``python -m siftlake <job> --help``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from siftlake.operators.mutations import delete_from_path, delete_from_table, delete_preview
from siftlake.operators.profile import sample_rows, schema_rows, value_frequency
from siftlake.plans.export import gated_export
from siftlake.plans.flow import fill_layers, run_flow
from siftlake.plans.lake_validation import lake_checks, report_of, schema_evolution
from siftlake.session import BASE_CONF, LARGE_CONF, make_session
from siftlake.sinks.messages import publish_files, publish_topic
from siftlake.sources.generated import DEMO_EVENTS, generate_events
from siftlake.sources.messages import KafkaTopic, MessageFiles, MessageSource
from siftlake.sources.tables import read_path, read_table
from siftlake.streaming.ingest import ingest_events


def _source(args: argparse.Namespace) -> MessageSource:
    if args.servers:
        return KafkaTopic(args.servers, args.topic, max_per_trigger=args.max_per_trigger)
    return MessageFiles(args.topic, args.max_per_trigger)


def produce(spark: SparkSession, args: argparse.Namespace) -> bool:
    events = generate_events(spark, args.events)
    if args.servers:
        publish_topic(events, args.servers, args.topic, args.charset)
    else:
        publish_files(events, args.topic, events["id"] * 0, events["id"], args.charset)
    return True


def ingest(spark: SparkSession, args: argparse.Namespace) -> bool:
    check = ingest_events(
        spark, _source(args), args.table, args.checkpoint, args.seconds, charset=args.charset, fmt=args.format
    )
    check.nulls.show(truncate=False)
    check.stats.show(truncate=False)
    return check.succeeded


def export(spark: SparkSession, args: argparse.Namespace) -> bool:
    outcome = gated_export(read_path(spark, args.table, args.format, merge_schema=True), args.target, replace_all=not args.keep_dates)
    outcome.results.drop("findings").show(truncate=False)
    outcome.report.show()
    return outcome.exported


def validate(spark: SparkSession, args: argparse.Namespace) -> bool:
    df = read_path(spark, args.path, merge_schema=True)
    schema_rows(df).show(truncate=False)
    sample_rows(df).show(truncate=False)
    checks = lake_checks(df)
    for part in (checks.results.drop("findings"), checks.profile, checks.dates, checks.stats):
        if part is not None:
            part.show(truncate=False)
    evolution = schema_evolution(df)
    evolution.show(truncate=False)
    report_of(checks, evolution).show(truncate=False)
    return True


def delete(spark: SparkSession, args: argparse.Namespace) -> bool:
    if args.dry_run:
        df = read_path(spark, args.path, args.format) if args.path else read_table(spark, args.table)
        delete_preview(df, args.condition).show()
    elif args.table:
        delete_from_table(spark, args.table, args.condition).show()
    else:
        target, counts = delete_from_path(spark, args.path, args.condition, args.target, args.format)
        counts.show()
        print(f"remaining rows are in {target}")
    return True


def frequency(spark: SparkSession, args: argparse.Namespace) -> bool:
    value_frequency(read_path(spark, args.path, args.format), args.column, args.top).show(args.top, truncate=False)
    return True


def layers(spark: SparkSession, args: argparse.Namespace) -> bool:
    fill_layers(spark, args.export, args.location).show(truncate=False)
    return True


def flow(spark: SparkSession, args: argparse.Namespace) -> bool:
    done = run_flow(spark, _source(args), args.root)
    for part in (done.ingest.stats, done.export and done.export.report, done.validation, done.tables):
        if part is not None:
            part.show(truncate=False)
    return done.tables is not None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siftlake", description=__doc__)
    top.add_argument("--large", action="store_true", help="settings for many terabytes")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run, help_text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=help_text)
        sub.set_defaults(run=run)
        return sub

    def messages(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--servers", help="broker addresses; without them --topic is a folder of message files")
        sub.add_argument("--topic", required=True)
        sub.add_argument("--max-per-trigger", type=int, help="offsets or files per micro-batch")

    sub = job(produce, "send test events")
    messages(sub)
    sub.add_argument("--events", type=int, default=DEMO_EVENTS)
    sub.add_argument("--charset", default="utf-8")

    sub = job(ingest, "messages to the raw table")
    messages(sub)
    sub.add_argument("--table", required=True)
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--seconds", type=float, help="run this long instead of draining the source")
    sub.add_argument("--charset", default="utf-8")
    sub.add_argument("--format", default="parquet")

    sub = job(export, "check the raw table and export it by date when it passes")
    sub.add_argument("--table", required=True)
    sub.add_argument("--target", required=True)
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--keep-dates", action="store_true", help="replace only the dates in the input")

    sub = job(validate, "look over an export")
    sub.add_argument("--path", required=True)

    sub = job(delete, "delete rows, or show how many would go")
    place = sub.add_mutually_exclusive_group(required=True)
    place.add_argument("--path")
    place.add_argument("--table")
    sub.add_argument("--condition", help="SQL predicate; without it all rows go")
    sub.add_argument("--target", help="where the remaining rows of a Parquet path go")
    sub.add_argument("--format", default="parquet")
    sub.add_argument("--dry-run", action="store_true")

    sub = job(frequency, "the most frequent values of a column")
    sub.add_argument("--path", required=True)
    sub.add_argument("--column", default="type")
    sub.add_argument("--top", type=int, default=20)
    sub.add_argument("--format", default="parquet")

    sub = job(layers, "register an export as bronze and refill silver and gold")
    sub.add_argument("--export", required=True)
    sub.add_argument("--location", required=True)

    sub = job(flow, "all stages in order")
    messages(sub)
    sub.add_argument("--root", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = make_session(f"siftlake-{args.job}", LARGE_CONF if args.large else BASE_CONF)
    return 0 if args.run(spark, args) else 1


if __name__ == "__main__":
    sys.exit(main())
