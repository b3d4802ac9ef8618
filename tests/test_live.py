"""The live view: state with a watermark, restarts, late and untimed readings."""

from random import Random

import pytest

from samples import message
from test_averages import as_dict, expected_averages, sensor_messages
from wellgauge import METRICS, MessageSource
from wellgauge.plans import land
from wellgauge.schemas import HOURLY, LIVE
from wellgauge.sources import stream_messages
from wellgauge.streaming import await_all, late_readings, live, read_live, start_live


def arrive(spark, config, path, delay="2 hours"):
    land(spark, config, stream_messages(spark, MessageSource("parquet", {"path": path})))
    queries = start_live(spark, config, delay)
    await_all(*queries)
    return queries[0]


def averages(spark, config):
    return as_dict(read_live(spark, config).select(*HOURLY.names))


def state_rows(query):
    return query.lastProgress.stateOperators[0].numRowsTotal


def at(hour, minute=0, value=1.0, day=1):
    return message(stamp=f"2021-06-{day:02}T{hour:02}:{minute:02}:00Z", value=value)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_all_averages_within_the_delay(spark, config, log, seed):
    """Junk, bad stamps and NULL wells; restarts between the parts."""
    texts = sensor_messages(seed, 300)
    Random(seed).shuffle(texts)
    assert read_live(spark, config).collect() == []
    for part in (texts[:120], texts[120:200], texts[200:]):
        query = arrive(spark, config, log(part), delay="3650 days")
    assert averages(spark, config) == expected_averages(texts, METRICS)
    assert late_readings(query) == 0


def test_state_falls_behind_the_watermark(spark, config, log):
    arrive(spark, config, log([at(h) for h in range(10)]))
    early = arrive(spark, config, log([at(9, 30, 3.0)]))
    assert state_rows(early) <= 10
    arrive(spark, config, log([at(8, day=2)]))
    later = arrive(spark, config, log([at(9, day=2)]))
    assert state_rows(later) == 2  # of the second day
    got = averages(spark, config)
    assert len(got) == 12 and got["7", "well_pump_rpm", 2021, 6, 1, 9] == 2.0


def test_late_readings_are_counted_and_untimed_ones_averaged(spark, config, log):
    arrive(spark, config, log([at(1, value=5.0), message(stamp="?", value=2.0)]))
    arrive(spark, config, log([at(20)]))
    query = arrive(spark, config, log([at(1, value=7.0), message(stamp=None, value=4.0), at(21)]))
    assert late_readings(query) == 1
    got = averages(spark, config)
    assert got["7", "well_pump_rpm", 2021, 6, 1, 1] == 5.0
    assert got["7", "well_pump_rpm", None, None, None, None] == 3.0
    readings = {r.hour: r.readings for r in read_live(spark, config).collect()}
    assert readings == {None: 2, 1: 1, 20: 1, 21: 1}


def live_rows(spark, *rows):
    return spark.createDataFrame([(w, "m", None, v, n) for w, v, n in rows], LIVE[:5])


def test_snapshots_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "live")
    want = {}
    for batch_id in [0, 0, *range(1, 21), 20, *range(21, 31), 30, 30]:
        rows = [(str(batch_id % 7), float(batch_id), batch_id + 1)]
        live.store_batch(live_rows(spark, *rows), batch_id, path)
        want |= {w: (v, n) for w, v, n in rows}
        stored = live._newest(live._stored(spark, path, live._batches(spark, path)))
        assert {r.well_id: (r.hourly_avg_value, r.readings) for r in stored.collect()} == want
    assert live._batches(spark, path) == list(range(20, 31))
