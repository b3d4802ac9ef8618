"""What landing would lose: content that does not decode, offsets that are gone, rows."""

import random

import pytest
from pyspark.sql import functions as F

from samples import ENVELOPES, message
from wellgauge import JobConfig, MessageSource
from wellgauge.operators import offset_gaps, offsets, rejects, same_rows, undecoded
from wellgauge.plans import land
from wellgauge.schemas import MESSAGE_LOG, REJECTS
from wellgauge.sources import read_rejects, stream_messages
from wellgauge.streaming import await_all, read_gaps, start_offset_audit
from wellgauge.streaming.audit import audit_batch

# --- rejects -------------------------------------------------------------------------

REASONS = {
    None: rejects.NO_VALUE,
    "": rejects.BLANK,
    " \t\n": rejects.BLANK,
    "not json": rejects.NO_JSON,
    '{"name":"x"': rejects.NO_JSON,
    "5": rejects.JSON_VALUE,
    '"a"': rejects.JSON_VALUE,
    "null": rejects.JSON_VALUE,
    "[]": rejects.JSON_ARRAY,
    '[{"name":"a"}]': rejects.JSON_ARRAY,
    "{}": rejects.NO_FIELD,
    '{"NAME":"x","extra":1}': rejects.NO_FIELD,
    '{"name":null}': rejects.NO_FIELD,
}


def test_reasons(spark, messages):
    found = undecoded(messages([*REASONS, message()]))
    assert found.schema.simpleString() == REJECTS.simpleString()
    got = {None if r.value is None else bytes(r.value).decode(): r.reason for r in found.collect()}
    assert got == REASONS


def test_exactly_the_rows_of_nothing_are_kept(spark, messages):
    """Every text of the decoding table, and bytes that are no text."""
    texts = [*[m for m, _ in ENVELOPES], b"\xff\xfe\x80", b'{"name":"\xff"}']
    lost = [m for m, row in ENVELOPES if set(row) == {None}] + [b"\xff\xfe\x80"]
    found = undecoded(messages(texts)).collect()
    want = [m.encode() if isinstance(m, str) else m for m in lost]
    assert sorted(map(repr, (None if r.value is None else bytes(r.value) for r in found))) == sorted(
        map(repr, want)
    )


def test_landing_keeps_rejects_once(spark, config, log):
    for texts in (["junk", message()], ["more junk", None], [message()]):
        source = MessageSource("parquet", {"path": log(texts)})
        land(spark, config, stream_messages(spark, source))
    kept = read_rejects(spark, config.layout.rejects).collect()
    assert sorted(str(r.value and bytes(r.value)) for r in kept) == [
        "None", "b'junk'", "b'more junk'"
    ]
    assert {(r.topic, r.partition) for r in kept} == {("replay", 0)}


def test_rejects_can_be_left_out(spark, config, log, tmp_path):
    config = JobConfig(config.layout, keep_rejects=False)
    land(spark, config, stream_messages(spark, MessageSource("parquet", {"path": log(["x"])})))
    assert not (tmp_path / "tables" / "rejects").exists()


# --- offsets -------------------------------------------------------------------------


def numbered(spark, rows):
    return spark.createDataFrame(rows, "topic STRING, partition INT, offset LONG")


def brute_gaps(rows):
    seen = {}
    for topic, partition, offset in rows:
        if partition is not None and offset is not None:
            seen.setdefault((topic, partition), set()).add(offset)
    gaps = []
    for key, offsets_ in seen.items():
        ordered = sorted(offsets_)
        for a, b in zip(ordered, ordered[1:], strict=False):
            if b > a + 1:
                gaps.append((*key, a + 1, b - 1, b - a - 1))
    return sorted(gaps, key=repr)


def gaps_of(table):
    return sorted(map(tuple, table.collect()), key=repr)


@pytest.mark.parametrize("block", [1_000_000, 50, 1])
def test_gaps_as_by_brute_force(spark, monkeypatch, block):
    """Any order and split of the messages, repeats, several topics, and blocks without
    a message."""
    monkeypatch.setattr(offsets, "BLOCK", block)
    rnd = random.Random(block)
    rows = [
        (rnd.choice(["a", "b", None]), rnd.choice([0, 1, None]), rnd.choice([None, rnd.randrange(400)]))
        for _ in range(900)
    ]
    rows += [("a", 0, 10_000 + i) for i in range(300)]
    table = numbered(spark, rows).repartition(5)
    assert gaps_of(offset_gaps(table)) == brute_gaps(rows)


def test_no_messages_have_no_gaps(spark):
    assert gaps_of(offset_gaps(numbered(spark, []))) == []


def test_a_row_for_each_island_is_shuffled(spark):
    rows = spark.range(100_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")
    )
    assert offsets.offset_islands(rows.coalesce(4)).count() <= 4 * 13


@pytest.mark.parametrize("seed", [1, 2])
def test_gaps_between_batches_and_repeated_batches(spark, tmp_path, seed):
    rnd = random.Random(seed)
    ends, gaps = str(tmp_path / "ends"), str(tmp_path / "gaps")
    kept = sorted(rnd.sample(range(300), 200))
    rows = [("t", p, o) for o in kept for p in (0, 1) if not (p and 90 < o < 160)]
    cuts = [0, 60, 61, 150, 300]
    for batch_id in (0, 0, 1, 1, 2, 2, 3):
        low, high = cuts[batch_id], cuts[batch_id + 1]
        audit_batch(
            numbered(spark, [r for r in rows if low <= r[2] < high]), batch_id, ends, gaps
        )
    found = spark.read.parquet(gaps).drop("log", "batch_id")
    assert gaps_of(found) == brute_gaps(rows)
    assert len(list((tmp_path / "ends").iterdir())) <= 3


def test_offsets_of_a_log_that_lost_some(spark, config, tmp_path):
    config = JobConfig(config.layout, check_offsets=True)
    path = str(tmp_path / "log")
    assert read_gaps(spark, config).collect() == []
    for offsets_ in ([0, 1, 2, 5], [6, 7], [20, 21]):
        rows = [(b"k", b"{}", "t", 3, o, None, 0) for o in offsets_]
        spark.createDataFrame(rows, MESSAGE_LOG).coalesce(1).write.mode("append").parquet(path)
        messages = stream_messages(spark, MessageSource("parquet", {"path": path}))
        land(spark, config, messages)
        await_all(start_offset_audit(messages, config))  # nothing new
    assert gaps_of(read_gaps(spark, config)) == [("t", 3, 3, 4, 2), ("t", 3, 8, 19, 12)]


# --- checksums ------------------------------------------------------------------------


def test_same_rows(spark):
    rows = [(1, "a", None), (1, "a", None), (2, None, "a"), (None, None, None)]
    kind = "g LONG, x STRING, y STRING"
    table = spark.createDataFrame(rows, kind)

    def same(other, by=()):
        found = same_rows(spark.createDataFrame(other, kind).repartition(3), table, by).collect()
        return {r.g: r.same for r in found} if by else found[0].same

    assert same(rows[::-1]) is True
    assert same(rows[1:]) is False  # a repeated row counts
    assert same([*rows[:2], (2, "a", None), rows[3]]) is False  # a value in the next column
    assert same([*rows[:3], (None, "", None)]) is False
    assert same([]) is False
    assert same([*rows[:2], (2, None, "b"), (3, "n", "n")], ["g"]) == {
        1: True, 2: False, 3: False, None: False
    }
    assert same_rows(table.limit(0), table.limit(0)).collect()[0].same is True
