import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.functions.codec import CHARSETS, decode_text, encode_row, escape_non_ascii, parse_messages, to_messages
from siftlake.functions.columns import stamp_ingest, text_length, with_partition_date
from siftlake.schemas import EVENT_SCHEMA, MESSAGE_SCHEMA, with_types


def parsed(spark, *payloads, schema=EVENT_SCHEMA, charset="utf-8"):
    rows = [(0, i, p if p is None or isinstance(p, bytes) else p.encode()) for i, p in enumerate(payloads)]
    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    out = parse_messages(messages, schema, charset).orderBy("kafka_offset").collect()
    return [(r.id, r.value, r.type, r.timestamp) for r in out]


NOTHING = (None, None, None, None)


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"id":1,"value":2,"type":"a","timestamp":3}', (1, 2, "a", 3)),
        ('{"id":1}', (1, None, None, None)),
        ('{"id":1,"other":9}', (1, None, None, None)),
        ('{"id":"x","value":2}', (None, 2, None, None)),
        ('{"id":"7","value":2}', (None, 2, None, None)),
        ('{"id":1.5,"value":2}', (None, 2, None, None)),
        ('{"id":99999999999,"value":2}', (None, 2, None, None)),
        ('{"id":1', NOTHING),
        ("not json", NOTHING),
        ('[{"id":1},{"id":2}]', NOTHING),
        ("null", NOTHING),
        ("", NOTHING),
        (None, NOTHING),
        ('﻿{"id":1}', NOTHING),
        ('{"ID":1}', NOTHING),
    ],
)
def test_every_payload_is_one_row(spark, payload, expected):
    assert parsed(spark, payload) == [expected]


def test_wide_ids_and_message_metadata(spark):
    schema = with_types(EVENT_SCHEMA, id=T.LongType())
    assert parsed(spark, '{"id":99999999999}', schema=schema) == [(99999999999, None, None, None)]
    messages = spark.createDataFrame([(3, 17, b'{"id":1}')], MESSAGE_SCHEMA)
    row = parse_messages(messages).first()
    assert (row.kafka_partition, row.kafka_offset) == (3, 17)
    with pytest.raises(ValueError):
        with_types(EVENT_SCHEMA, nope=T.LongType())


def test_bom_is_stripped_by_utf_8_sig(spark):
    assert parsed(spark, '﻿{"id":1}', charset="utf-8-sig") == [(1, None, None, None)]


@pytest.mark.parametrize(
    "data, charset, text",
    [
        ("é漢😀".encode(), "utf-8", "é漢😀"),
        (b"\xe9abc", "utf-8", "�abc"),
        (b"\xe9abc", "latin-1", "éabc"),
        (b"\xe9abc", "ascii", "�abc"),
        (b"\xef\xbb\xbfabc", "utf-8", "﻿abc"),
        (b"\xef\xbb\xbfabc", "utf-8-sig", "abc"),
        (b"\xef\xbb\xbf\xef\xbb\xbfabc", "utf-8-sig", "﻿abc"),
        (b"", "utf-8-sig", ""),
        (None, "utf-8", None),
    ],
)
def test_decode(spark, data, charset, text):
    df = spark.createDataFrame([(data,)], "b binary")
    assert df.select(decode_text(F.col("b"), charset)).first()[0] == text


def test_unknown_charset():
    for use in (lambda: decode_text(None, "utf-16"), lambda: encode_row([], "cp1252")):
        with pytest.raises(ValueError, match="unsupported charset"):
            use()


@pytest.mark.parametrize("charset", CHARSETS)
def test_encoded_rows_are_ascii_json_and_read_back(spark, charset):
    rows = [(1, 10, "plain", 5), (2, None, 'é "漢" 😀\n', 6)]
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    messages = to_messages(df, F.lit(0), F.col("id"), charset)
    sent = [bytes(r.value) for r in messages.orderBy("offset").collect()]
    for data, row in zip(sent, rows):
        body = data.decode("utf-8-sig")
        assert body.isascii()
        assert json.loads(body) == dict(zip(EVENT_SCHEMA.names, row))
    assert sent[0].startswith(b"\xef\xbb\xbf") == (charset == "utf-8-sig")
    back = parse_messages(messages, charset=charset).orderBy("id").collect()
    assert [(r.id, r.value, r.type, r.timestamp) for r in back] == rows


def test_escape_matches_python(spark):
    text = 'a"é漢😀\\u00e9'
    made = spark.createDataFrame([(json.dumps(text, ensure_ascii=False),)], "t string")
    assert made.select(escape_non_ascii(F.col("t"))).first()[0] == json.dumps(text)


def test_partition_date(spark):
    at = spark.sql("SELECT timestamp'2024-03-01 23:59:59' AS ingested_at")
    assert str(with_partition_date(at).first().ingestion_date) == "2024-03-01"
    kept = spark.sql("SELECT timestamp'2024-03-01 00:00:00' AS ingested_at, date'2020-01-01' AS ingestion_date")
    assert str(with_partition_date(kept).first().ingestion_date) == "2020-01-01"
    today = with_partition_date(spark.range(1)).select("ingestion_date", F.current_date().alias("today")).first()
    assert today.ingestion_date == today.today


def test_stamp_is_one_value_per_batch(spark):
    stamped = stamp_ingest(spark.range(0, 1000, 1, 8))
    assert stamped.select("ingested_at").distinct().count() == 1
    assert dict(stamped.dtypes)["ingested_at"] == "timestamp"


def test_text_length_counts_characters_and_null_as_zero(spark):
    df = spark.createDataFrame([("é漢😀",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(text_length("t")).collect()] == [3, 0, 0]
