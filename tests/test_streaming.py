import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from siftlake.schemas import EVENT_SCHEMA, MESSAGE_SCHEMA, RAW_SCHEMA
from siftlake.sinks.exports import write_by_date
from siftlake.sinks.messages import publish_files, publish_topic
from siftlake.sources.generated import generate_events
from siftlake.sources.messages import KafkaTopic, MessageFiles
from siftlake.sources.files import incremental_parquet
from siftlake.sources.schema_log import SchemaConflict, SchemaLog
from siftlake.sources.tables import read_path
from siftlake.streaming import bronze, live
from siftlake.streaming.bronze import ledger_path, load_bronze
from siftlake.streaming.ingest import (
    append_stream,
    check_ingested,
    event_stream,
    finish,
    ingest_events,
)


@pytest.fixture
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("topic", "raw", "checkpoint", "bronze")}


def send(spark, places, n, first=0):
    events = generate_events(spark, n).withColumn("id", F.col("id") + first)
    publish_files(events.coalesce(1), places["topic"], F.lit(0), F.col("id"))


def run(spark, places, **options):
    return ingest_events(spark, MessageFiles(places["topic"]), places["raw"], places["checkpoint"], **options)


def test_fifty_events_arrive_once(spark, places):
    send(spark, places, 50)
    check = run(spark, places)
    assert check.succeeded and check.nulls.first().status == "PASS"
    raw = read_path(spark, places["raw"])
    assert {(f.name, f.dataType) for f in raw.schema} == {(f.name, f.dataType) for f in RAW_SCHEMA}
    stats = raw.agg(F.count("*"), F.min("id"), F.max("id"), F.avg("value"), F.max("kafka_offset")).first()
    assert tuple(stats) == (50, 0, 49, 245.0, 49)


def test_restart_goes_on_where_it_stopped(spark, places):
    send(spark, places, 50)
    run(spark, places)
    run(spark, places)
    assert read_path(spark, places["raw"]).count() == 50
    send(spark, places, 1, first=50)
    run(spark, places)
    assert read_path(spark, places["raw"]).count() == 51
    assert read_path(spark, places["raw"]).select("id").distinct().count() == 51


def test_bad_messages_become_null_rows_and_do_not_stop_the_stream(spark, places):
    payloads = [b'{"id":1,"value":1,"type":"a","timestamp":1}', b"\xff\xfe", b"not json", None]
    rows = [(0, i, p) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.parquet(places["topic"])
    check = run(spark, places)
    assert check.succeeded and check.stats.first().total_rows == 4
    assert check.nulls.first().detail == "id(3), value(3), type(3), timestamp(3)"


def test_rate_limit_makes_several_batches(spark, places):
    for i in range(4):
        send(spark, places, 10, first=10 * i)
    source = MessageFiles(places["topic"], max_per_trigger=1)
    query = append_stream(event_stream(spark, source), places["raw"], places["checkpoint"])
    finish(query)
    batches = [p for p in query.recentProgress if p.numInputRows > 0]
    assert [p.numInputRows for p in batches] == [10, 10, 10, 10]
    assert read_path(spark, places["raw"]).count() == 40


def test_timed_run_stops(spark, places):
    send(spark, places, 20)
    check = run(spark, places, seconds=8)
    assert check.succeeded and not spark.streams.active
    assert read_path(spark, places["raw"]).count() == 20


def test_nothing_arrived(spark, places):
    spark.createDataFrame([], MESSAGE_SCHEMA).write.parquet(places["topic"])
    spark.createDataFrame([], RAW_SCHEMA).write.parquet(places["raw"])
    check = check_ingested(spark, places["raw"])
    assert not check.succeeded and check.nulls.first().status == "SKIP"


def test_schema_may_grow_between_runs(spark, places):
    send(spark, places, 2)
    run(spark, places)
    message = (0, 9, b'{"id":9,"note":"n"}')
    spark.createDataFrame([message], MESSAGE_SCHEMA).write.mode("append").parquet(places["topic"])
    run(spark, places, schema=T.StructType([*EVENT_SCHEMA.fields, T.StructField("note", T.StringType())]))
    raw = read_path(spark, places["raw"], merge_schema=True)
    assert raw.filter("note = 'n'").count() == 1 and raw.count() == 3


def test_bronze_loads_only_new_files(spark, places, tmp_path):
    export = str(tmp_path / "export")
    day = lambda d: generate_events(spark, 10).withColumn("ingestion_date", F.lit(d).cast("date"))
    write_by_date(day("2024-01-01"), export)
    (tmp_path / "export" / "notes.txt").write_text("not parquet")
    load_bronze(spark, export, places["bronze"], places["checkpoint"])
    load_bronze(spark, export, places["bronze"], places["checkpoint"])
    assert read_path(spark, places["bronze"]).count() == 10
    write_by_date(day("2024-01-02"), export, replace_all=False)
    load_bronze(spark, export, places["bronze"], places["checkpoint"])
    bronze = read_path(spark, places["bronze"])
    assert bronze.count() == 20 and dict(bronze.dtypes)["ingestion_date"] == "date"
    assert (tmp_path / "bronze" / "ingestion_date=2024-01-02").is_dir()


def day(spark, date, first=0, n=10):
    events = generate_events(spark, n).withColumn("id", F.col("id") + first)
    return events.withColumn("ingestion_date", F.lit(date).cast("date"))


def ids(spark, path):
    return sorted(r.id for r in read_path(spark, path, merge_schema=True).select("id").collect())


def test_a_whole_export_may_be_loaded_again(spark, places, tmp_path):
    export = str(tmp_path / "export")
    load = lambda: load_bronze(spark, export, places["bronze"], places["checkpoint"])
    both = day(spark, "2024-01-01").unionByName(day(spark, "2024-01-02", 10))
    write_by_date(both, export)
    load()
    write_by_date(both, export)
    load()
    assert ids(spark, places["bronze"]) == list(range(20))
    # A date that is written again with other rows, one that goes, one that is added to, and rows without a date.
    write_by_date(day(spark, "2024-01-02", 30, 5).unionByName(day(spark, None, 50, 2)), export)
    load()
    day(spark, "2024-01-02", 40, 3).write.mode("append").partitionBy("ingestion_date").parquet(export)
    load()
    assert ids(spark, places["bronze"]) == [30, 31, 32, 33, 34, 40, 41, 42, 50, 51]
    ledger = spark.read.parquet(ledger_path(places["checkpoint"]))
    assert sorted((r.generation, r.rows) for r in ledger.collect()) == [(0, 10), (0, 10), (1, 10), (1, 10), (2, 2), (2, 5), (3, 3)]


def test_a_load_lost_half_way_is_repeated(spark, places, tmp_path, monkeypatch):
    export = str(tmp_path / "export")
    write_by_date(day(spark, "2024-01-01").unionByName(day(spark, "2024-01-02", 10)), export)

    def lost(rows, path, **options):
        write_by_date(rows, path, **options)
        raise RuntimeError("lost after the rows were written")

    monkeypatch.setattr(bronze, "write_by_date", lost)
    with pytest.raises(Exception, match="lost after"):
        load_bronze(spark, export, places["bronze"], places["checkpoint"])
    monkeypatch.undo()
    # Whoever exports meanwhile replaces the files that the lost batch was about.
    write_by_date(day(spark, "2024-01-01").unionByName(day(spark, "2024-01-02", 10)), export)
    load_bronze(spark, export, places["bronze"], places["checkpoint"])
    assert ids(spark, places["bronze"]) == list(range(20))


def test_new_columns_add_a_version_and_a_start_opens_no_file(spark, places, tmp_path):
    export = str(tmp_path / "export")
    write_by_date(day(spark, "2024-01-01"), export)
    load_bronze(spark, export, places["bronze"], places["checkpoint"])
    log = SchemaLog.beside(spark, export)
    assert log.versions() == [1]
    noted = day(spark, "2024-01-02", 10).withColumn("note", F.lit("n"))
    noted.write.mode("append").partitionBy("ingestion_date").parquet(export)
    load_bronze(spark, export, places["bronze"], places["checkpoint"])
    assert log.versions() == [1, 2] and "note" in log.latest().names
    found = read_path(spark, places["bronze"], merge_schema=True)
    assert found.where("note = 'n'").count() == 10 and found.count() == 20
    # Files that can't be opened: what needs their footers fails, what goes by the log does not.
    for file in (tmp_path / "export").rglob("*.parquet"):
        file.chmod(0o644)
        file.write_bytes(b"no parquet")
    started = incremental_parquet(spark, export)
    assert started.isStreaming and set(started.columns) == set(log.latest().names)
    assert set(read_path(spark, export, merge_schema=True).columns) == set(log.latest().names)
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", "true").parquet(export)


def test_schema_log(spark, tmp_path):
    log = SchemaLog(spark, str(tmp_path / "log"))
    assert log.latest() is None and log.versions() == []
    one = T.StructType([T.StructField("a", T.LongType(), False)])
    assert log.add(one) == T.StructType([T.StructField("a", T.LongType())]) == log.add(one) == log.latest()
    two = T.StructType([T.StructField("A", T.LongType()), T.StructField("b", T.ArrayType(T.StringType()))])
    assert log.add(two).names == ["a", "b"] and log.versions() == [1, 2]
    with pytest.raises(SchemaConflict, match="a is bigint in the log and string"):
        log.add(T.StructType([T.StructField("a", T.StringType())]))
    assert log.add(T.StructType([T.StructField("a", T.StringType())]), anew=True).names == ["a"]
    assert log.versions() == [1, 2, 3] and log.version(2).names == ["a", "b"]
    # A writer that comes second goes on from what the first wrote.
    other = SchemaLog(spark, log.path)
    seen = iter([[1, 2], [1, 2, 3]])
    other.versions = lambda: next(seen)
    assert other.add(T.StructType([T.StructField("z", T.DateType())])).names == ["a", "z"] and log.versions()[-1] == 4


def test_topic_options():
    topic = KafkaTopic("h:9092", "events", max_per_trigger=100, extra={"kafka.security.protocol": "SSL"})
    common = {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "SSL",
    }
    assert topic.options(streaming=True) == common | {"maxOffsetsPerTrigger": "100"}
    assert topic.options(streaming=False) == common


def test_topic_needs_the_connector(spark):
    topic = KafkaTopic("h:9092", "events")
    for use in (
        lambda: topic.stream(spark),
        lambda: topic.batch(spark),
        lambda: publish_topic(spark.range(1), "h:9092", "events"),
    ):
        with pytest.raises(AnalysisException, match="kafka"):
            use()


def test_batch_read_of_message_files(spark, places):
    send(spark, places, 5)
    assert MessageFiles(places["topic"]).batch(spark).count() == 5


def watched(spark, places, **options):
    counts = live.BatchCounts(spark, places["raw"] + "-counts")
    source = MessageFiles(places["topic"], max_per_trigger=1)
    rows = live.ingest_watched(spark, source, places["raw"], places["checkpoint"], counts, **options)
    return sorted(tuple(r) for r in rows.collect())


def table_counts(spark, places):
    table = read_path(spark, places["raw"])
    return (table.count(), *(table.where(F.col(c).isNull()).count() for c in ("id", "value", "type", "timestamp")))


def added_up(rows):
    return tuple(sum(r[k] for r in rows) for k in range(1, 6))


def test_live_checks_add_up_to_the_table(spark, places):
    broken = [(0, 100 + i, b"not json") for i in range(3)]
    send(spark, places, 10)
    spark.createDataFrame(broken, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(places["topic"])
    rows = watched(spark, places)
    assert sorted(r[1:] for r in rows) == [(3, 3, 3, 3, 3), (10, 0, 0, 0, 0)] and [r[0] for r in rows] == [0, 1]
    assert added_up(rows) == table_counts(spark, places) == (13, 3, 3, 3, 3)
    assert watched(spark, places) == rows
    send(spark, places, 7, first=10)
    again = watched(spark, places)
    assert again[:2] == rows and again[2] == (2, 7, 0, 0, 0, 0) and len(again) == 3


def test_live_checks_of_a_lost_driver_are_made_good(spark, places, monkeypatch):
    send(spark, places, 10)
    with monkeypatch.context() as lost:
        # Reports of the batches after the first never arrive, and the run does not come to its end.
        kept = live.BatchCounts.write
        lost.setattr(live.BatchCounts, "write", lambda self, batch, *rest: batch == 0 and kept(self, batch, *rest))
        lost.setattr(live, "REPORTS_WITHIN", 0.5)
        for k in (1, 2):
            send(spark, places, 5, first=10 * k)
        watched(spark, places)
    assert live.BatchCounts(spark, places["raw"] + "-counts").rows().count() == 1
    send(spark, places, 4, first=30)
    rows = watched(spark, places)
    assert added_up(rows) == table_counts(spark, places) and added_up(rows)[0] == 24
    assert [r[:2] for r in rows] == [(0, rows[0][1]), (2, 20 - rows[0][1]), (3, 4)]
    assert watched(spark, places) == rows


def test_live_checks_of_a_batch_are_written_once(spark, places):
    counts = live.BatchCounts(spark, places["raw"] + "-counts", ["id"])
    assert counts.rows().columns == ["batch", "rows", "missing_id"] and counts.rows().count() == 0
    assert counts.write(4, {"rows": 2, "missing_id": None}) and not counts.write(4, {"rows": 9, "missing_id": 9})
    assert [tuple(r) for r in counts.rows().collect()] == [(4, 2, 0)]
    listener = live._Listener(counts, "x")
    listener.close()
    progress = type("P", (), {"observedMetrics": {"x": None}, "numInputRows": 3, "batchId": 5})
    listener.onQueryProgress(type("E", (), {"progress": progress}))
    assert counts.rows().count() == 1


def test_live_checks_of_nothing(spark, places):
    spark.createDataFrame([], MESSAGE_SCHEMA).write.parquet(places["topic"])
    assert added_up(watched(spark, places)) == (0, 0, 0, 0, 0)


def test_live_checks_of_a_timed_run(spark, places):
    send(spark, places, 20)
    assert added_up(watched(spark, places, seconds=8)) == table_counts(spark, places) == (20, 0, 0, 0, 0)
