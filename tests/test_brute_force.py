"""Random small tables against plain Python."""

import math
import random
import statistics
from collections import Counter

import pytest

from siftlake.operators import layers, mutations, profile
from siftlake.operators.quality import QualitySuite, findings, report, run_checks, settled

COLUMNS = "id int, value int, type string, timestamp long, kafka_partition int, kafka_offset long, price double"


def random_rows(seed):
    rng = random.Random(seed)

    def maybe(value, chance=0.1):
        return None if rng.random() < chance else value

    rows = []
    for offset in range(rng.choice([1, 40, 300])):
        # A third of the rows share one id.
        key = 7 if rng.random() < 0.33 else rng.randrange(60)
        price = rng.choice([float("nan"), 1e6, -1e6]) if rng.random() < 0.02 else rng.gauss(10, 3)
        rows.append(
            (
                maybe(key),
                maybe(rng.randrange(-20, 120)),
                maybe(rng.choice(["a", "b", "c�", "long" * 100])),
                maybe(rng.randrange(5)),
                offset % 3,
                offset,
                maybe(price),
            )
        )
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_against_plain_python(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    suite = QualitySuite(
        critical_columns=["id", "value", "type", "timestamp"],
        key_columns=["id", "type"],
        numeric_ranges={"value": (0, 100)},
        partition_column="id",
        max_string_length=399,
        rules={"cheap": "price > 1000"},
    )
    results = settled(run_checks(df, suite))
    found = {(r.check, r.column): r.violations for r in findings(results).collect()}

    for i, name in enumerate(["id", "value", "type", "timestamp"]):
        assert found["nulls", name] == sum(r[i] is None for r in rows)
    assert found["duplicates", "id, type"] == len(rows) - len({(r[0], r[2]) for r in rows})
    assert found["ranges", "value"] == sum(r[1] is not None and not 0 <= r[1] <= 100 for r in rows)
    assert found["data_types", "type"] == sum(len(r[2] or "") > 399 for r in rows)
    assert found["encoding", "type"] == sum("�" in (r[2] or "") for r in rows)
    assert found["custom", "cheap"] == sum(r[6] is not None and (r[6] > 1000 or math.isnan(r[6])) for r in rows)

    per_id = Counter(r[0] for r in rows)
    assert found["distribution", "id"] == (max(per_id.values()) > 10 * len(rows) / len(per_id))

    profiles = {r.column: r for r in profile.numeric_profile(df).collect()}
    for i, name in [(1, "value"), (6, "price")]:
        numbers = [r[i] for r in rows if r[i] is not None and not math.isnan(r[i])]
        assert profiles[name]["count"] == len(numbers)
        assert profiles[name].nan_count == sum(r[i] is not None and math.isnan(r[i]) for r in rows)
        if len(numbers) > 1:
            mean, deviation = statistics.fmean(numbers), statistics.stdev(numbers)
            assert profiles[name].avg == pytest.approx(mean)
            assert profiles[name].stddev == pytest.approx(deviation)
            assert found["anomalies", name] == sum(abs(n - mean) > 3 * deviation for n in numbers)

    status = Counter(r.status for r in results.collect())
    lost = sum(r.deduction for r in results.collect())
    score = max(0, 100 - lost)
    expected = (status["PASS"], status["WARN"], status["FAIL"], score, score >= 70 and not status["FAIL"])
    assert tuple(report(results).first()) == expected


@pytest.mark.parametrize("seed", range(3))
def test_silver_gold_and_delete_against_plain_python(spark, seed):
    rows = random_rows(seed + 100)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    latest = {}
    for row in rows:
        if None not in row[:4] and (row[0] not in latest or (row[3], row[5]) > (latest[row[0]][3], latest[row[0]][5])):
            latest[row[0]] = row
    silver = layers.silver_events(df).drop("processed_at").cache()
    assert {(r.id, r.kafka_offset) for r in silver.collect()} == {(r[0], r[5]) for r in latest.values()}

    totals = Counter(r[2] for r in latest.values())
    assert {r.event_type: r.total_events for r in layers.gold_metrics(silver).collect()} == dict(totals)

    doomed = {r[5] for r in rows if r[1] is not None and r[3] is not None and r[1] > 50 and r[3] < 3}
    condition = "value > 50 and timestamp < 3"
    assert mutations.delete_preview(df, condition).first().rows_to_delete == len(doomed)
    kept = {r.kafka_offset for r in mutations.without(df, condition).collect()}
    assert kept == {r[5] for r in rows} - doomed
