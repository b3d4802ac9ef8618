from collections import defaultdict
from datetime import UTC, datetime, timedelta
from random import Random

import pytest

from samples import message
from wellgauge import METRICS
from wellgauge.operators import (
    decode_envelope,
    hour_readings,
    hourly_avg,
    hourly_partials,
    merge_partials,
    payload_value,
)

START = datetime(2021, 6, 1, tzinfo=UTC)


def sensor_messages(seed, n):
    """Readings with one hot well, NULL wells, bad stamps, junk and odd payloads."""
    random = Random(seed)
    out = []
    for _ in range(n):
        kind = random.random()
        if kind < 0.03:
            out.append("not json")
            continue
        stamp = (START + timedelta(minutes=random.randrange(6 * 60))).isoformat()
        if kind < 0.08:
            stamp = "garbage"
        payload = None if kind < 0.9 else random.choice(["oops", '{"value":"x"}', '{"value":null}'])
        fields = dict(
            name=random.choice([*METRICS[:3], "other"]),
            well=random.choice(["1", "1", "1", "2", "3", None]),
            stamp=stamp,
            value=round(random.uniform(-5, 5), 2),
        )
        out.append(message(**fields) if payload is None else message(**fields, payload=payload))
    return out


def expected_averages(messages, metrics):
    """The same by hand."""
    import json

    groups = defaultdict(list)
    for text in messages:
        if not text.startswith("{"):
            continue
        row = json.loads(text)
        if row["name"] not in metrics:
            continue
        try:
            hour = datetime.fromisoformat(row["@timestamp"]).replace(minute=0)
            parts = (hour.year, hour.month, hour.day, hour.hour)
        except ValueError:
            parts = (None,) * 4
        try:
            value = json.loads(row["payload"])["value"]
        except ValueError:
            value = None
        groups[(row["well_id"], row["name"], *parts)].append(value)
    out = {}
    for key, values in groups.items():
        numbers = [v for v in values if isinstance(v, (int, float))]
        out[key] = round(sum(numbers) / len(numbers), 6) if numbers else None
    return out


def as_dict(hourly):
    rows = [tuple(r) for r in hourly.collect()]
    out = {r[:-1]: None if r[-1] is None else round(r[-1], 6) for r in rows}
    assert len(out) == len(rows), "a group appears twice"
    return out


@pytest.fixture(scope="module")
def texts():
    return [*sensor_messages(1, 3000), message(name=METRICS[1], well="9", payload="oops")]


@pytest.fixture
def decoded(messages, texts):
    return payload_value(decode_envelope(messages(texts)))


def test_all_metrics_against_brute_force(decoded, texts):
    want = expected_averages(texts, METRICS)
    assert any(None in key for key in want) and None in want.values()
    assert as_dict(hourly_avg(decoded, METRICS)) == want


def test_one_metric_uses_its_argument(decoded, texts):
    only = METRICS[1]
    assert as_dict(hourly_avg(decoded, only)) == expected_averages(texts, [only])


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_merged_partials_equal_the_whole(decoded, texts, parts):
    readings = hour_readings(decoded, METRICS)
    pieces = readings.randomSplit([1.0] * parts, seed=3)
    partials = hourly_partials(pieces[0])
    for piece in pieces[1:]:
        partials = partials.unionAll(hourly_partials(piece))
    assert as_dict(merge_partials(partials)) == expected_averages(texts, METRICS)


def test_session_zone_does_not_matter(spark, messages, texts):
    from wellgauge.session import job_session

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    job_session(spark)
    got = as_dict(hourly_avg(payload_value(decode_envelope(messages(texts))), METRICS))
    assert got == expected_averages(texts, METRICS)


def test_plan_reads_little_and_shuffles_once(spark, tmp_path, messages, texts):
    from wellgauge.sources import read_raw

    path = str(tmp_path / "raw")
    decode_envelope(messages(texts)).write.parquet(path)
    hourly = hourly_avg(payload_value(read_raw(spark, path)), METRICS)
    plan = hourly._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters: [In(name," in plan
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "@metadata" not in schema
    assert plan.count("\n(") and plan.count(") Exchange") == 1
    assert "partial_avg" in plan
    assert "from_json(StructField(value,DoubleType,true)" in plan
