"""Stored sums as deltas: what a batch writes, and what a broken merge leaves."""

from pathlib import Path
from random import Random

import pytest

from samples import message
from test_averages import as_dict, expected_averages, sensor_messages
from test_hourly_stream import read_hourly_in_order
from wellgauge import METRICS
from wellgauge.operators import decode_envelope, hour_readings, payload_value
from wellgauge.sources import ensure_hourly, read_hourly
from wellgauge.streaming import deltas as store
from wellgauge.streaming import refresh_hours
from wellgauge.streaming.deltas import Delta, live


@pytest.fixture
def refresh(spark, config, messages):
    ensure_hourly(spark, config.layout.hourly)

    def run(batch_id, texts):
        raw = decode_envelope(messages(texts))
        readings = hour_readings(payload_value(raw), METRICS)
        refresh_hours(readings, batch_id, config.partials_path, config.layout.hourly)
        return as_dict(read_hourly_in_order(spark, config))

    return run


def files(config):
    return {f: f.stat().st_size for f in Path(config.partials_path).rglob("part-*.parquet")}


def test_a_late_reading_does_not_write_its_date_again(refresh, config):
    random = Random(1)
    texts = [
        message(stamp=f"2021-06-01T{i % 24:02}:00:00Z", well=str(i), value=random.random())
        for i in range(20_000)
    ]
    got = refresh(0, texts)
    (first,) = files(config)
    whole = first.stat().st_size
    assert got == expected_averages(texts, METRICS)
    written = 0
    for batch_id in range(1, 9):
        before = files(config)
        late = [message(stamp="2021-06-01T07:30:00Z", well="7", value=float(batch_id))]
        texts += late
        got = refresh(batch_id, late)
        after = files(config)
        written += sum(size for f, size in after.items() if f not in before)
        assert first in after and len(after) <= 4
    assert written < whole / 10
    assert got == expected_averages(texts, METRICS)


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_of_any_sizes(refresh, config, seed):
    """Batches of very different sizes, some of them repeated."""
    random, texts = Random(seed), []
    for batch_id in range(10):
        batch = sensor_messages(100 * seed + batch_id, random.choice([1, 5, 40, 300]))
        texts += batch
        for _ in range(random.choice([1, 1, 2])):
            got = refresh(batch_id, batch)
        assert got == expected_averages(texts, METRICS)
    for date in Path(config.partials_path).glob("event_date=*"):
        assert len(list(date.glob("batches=*"))) < 8


@pytest.mark.parametrize("broken", ["write_partials", "delete"])
def test_a_merge_that_breaks_off_is_done_by_the_repeated_batch(refresh, config, monkeypatch, broken):
    batches = [sensor_messages(i, 60) for i in range(4)]
    for batch_id in (0, 1):
        refresh(batch_id, batches[batch_id])

    work, calls = getattr(store, broken), []

    def fail(*arguments):
        calls.append(arguments)
        # The first write is the delta, the second the merge; the first call of delete
        # is for what earlier merges left, the second for what was merged.
        if len(calls) == 2:
            if broken == "delete":
                _, folders = arguments
                work(arguments[0], folders[:1])
            raise OSError("broken")
        return work(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(store, broken, fail)
        with pytest.raises(OSError):
            refresh(2, batches[2])
    assert len(calls) == 2
    assert refresh(2, batches[2]) == expected_averages(sum(batches[:3], []), METRICS)
    assert refresh(3, batches[3]) == expected_averages(sum(batches, []), METRICS)
    for date in Path(config.partials_path).glob("event_date=*"):
        names = [d.name.removeprefix("batches=").split("-") for d in date.glob("batches=*")]
        found = [Delta(int(a), int(b), "") for a, b in names]
        assert sorted(live(found)) == sorted(found)


def test_deltas_within_the_range_of_another_do_not_count():
    made = [Delta(a, b, f"{a}-{b}") for a, b in ((3, 3), (0, 0), (0, 2), (2, 2), (0, 1), (5, 5))]
    assert [d.folder for d in live(made)] == ["0-2", "3-3", "5-5"]
    assert live([]) == []


def test_a_batch_without_readings_stores_nothing(refresh, config):
    assert refresh(0, ["junk"]) == {}
    assert files(config) == {}
    assert len(refresh(1, [message(value=2.0)])) == 1


def test_hours_of_many_deltas_are_one_row_a_group(spark, refresh, config):
    for batch_id in range(3):
        refresh(batch_id, [message(value=float(batch_id)), message(stamp="bad", value=1.0)])
    hourly = read_hourly(spark, config.layout.hourly)
    assert hourly.count() == 2
    assert hourly.filter("hour IS NOT NULL").first().hourly_avg_value == 1.0
