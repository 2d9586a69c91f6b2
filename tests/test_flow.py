import pytest
from pyspark.sql import functions as F

import siftlake.__main__ as cli
from siftlake.plans.flow import run_flow
from siftlake.schemas import MESSAGE_SCHEMA
from siftlake.session import BASE_CONF, LARGE_CONF, make_session
from siftlake.sinks.messages import publish_files
from siftlake.sources.generated import generate_events
from siftlake.sources.messages import MessageFiles


def test_fifty_events_through_all_stages(spark, tmp_path):
    topic = str(tmp_path / "topic")
    publish_files(generate_events(spark), topic, F.lit(0), F.col("id"))
    done = run_flow(spark, MessageFiles(topic), str(tmp_path), layer_prefix="flow_")
    assert done.ingest.stats.first().total_rows == 50
    assert tuple(done.export.report.first()) == (10, 0, 0, 100, True)
    assert [tuple(r)[:3] for r in done.validation.collect()] == [
        ("quality_checks", "PASSED", "PASS"),
        ("schema_evolution", "EVOLVED", "WARN"),
    ]
    assert done.tables.count() == 6
    gold = spark.table("flow_gold.events_metrics").first()
    assert tuple(gold)[:5] == ("test_event", 50, 245.0, 0, 490)


def test_a_closed_gate_stops_the_flow(spark, tmp_path):
    topic = str(tmp_path / "topic")
    publish_files(generate_events(spark, types=("unknown",)), topic, F.lit(0), F.col("id"))
    done = run_flow(spark, MessageFiles(topic), str(tmp_path))
    assert not done.export.exported and done.validation is None and not (tmp_path / "export").exists()


def test_no_messages_stop_the_flow(spark, tmp_path):
    topic = str(tmp_path / "topic")
    spark.createDataFrame([], MESSAGE_SCHEMA).write.parquet(topic)
    done = run_flow(spark, MessageFiles(topic), str(tmp_path))
    assert not done.ingest.succeeded and done.export is None


def test_command_line(spark, tmp_path, capsys):
    def run(*args):
        return cli.main([str(a) for a in args])

    topic, raw, export = tmp_path / "topic", tmp_path / "raw", tmp_path / "export"
    assert run("produce", "--topic", topic, "--events", 30) == 0
    assert run("ingest", "--topic", topic, "--table", raw, "--checkpoint", tmp_path / "c") == 0
    assert run("frequency", "--path", raw) == 0
    assert "test_event|30" in capsys.readouterr().out
    assert run("delete", "--path", raw, "--condition", "id < 10", "--dry-run") == 0
    assert "10" in capsys.readouterr().out
    assert run("delete", "--path", raw, "--condition", "id < 10", "--target", tmp_path / "kept") == 0
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 20
    assert run("export", "--table", raw, "--target", export) == 0
    assert run("validate", "--path", export) == 0
    assert "EVOLVED" in capsys.readouterr().out
    assert run("layers", "--export", export, "--location", tmp_path / "layers") == 0
    assert run("delete", "--table", "bronze.events_raw") == 0
    assert spark.table("bronze.events_raw").count() == 0
    assert run("delete", "--path", raw, "--target", tmp_path / "emptied") == 0
    assert run("export", "--table", tmp_path / "emptied", "--target", tmp_path / "none") == 1
    with pytest.raises(SystemExit):
        run("delete", "--condition", "id < 10")


def test_session(spark):
    assert make_session("x").sparkContext is spark.sparkContext
    assert BASE_CONF.items() <= LARGE_CONF.items()
