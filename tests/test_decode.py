import pytest
from pyspark.sql import functions as F

from samples import ENVELOPES, FULL, NOTHING, PAYLOADS, QUOTED, STAMPS
from wellgauge.operators import (
    as_text,
    decode_envelope,
    decode_nested,
    event_time_parts,
    hourly_avg,
    payload_profile,
    payload_value,
    reject_counts,
)
from wellgauge.schemas import RAW, RAW_NESTED


def raw_payloads(spark, payloads):
    rows = [("m", None, "x", p, "1") for p in payloads]
    return spark.createDataFrame(rows, RAW)


def test_every_message_gives_the_expected_row(messages):
    decoded = decode_envelope(messages([m for m, _ in ENVELOPES]).coalesce(1))
    assert decoded.schema == RAW
    assert [tuple(r) for r in decoded.collect()] == [row for _, row in ENVELOPES]


def test_nested_form_keeps_one_struct(messages):
    decoded = decode_nested(messages([m for m, _ in ENVELOPES]).coalesce(1))
    assert decoded.schema == RAW_NESTED
    structs = [r.value for r in decoded.collect()]
    assert [tuple(s) if s is not None else NOTHING for s in structs] == [r for _, r in ENVELOPES]
    # Empty, blank and missing values give no struct at all.
    assert [s is None for s in structs[-3:]] == [True] * 3


def test_invalid_utf8_is_no_error(messages):
    row = decode_envelope(messages([b'{"name":"a\xff\xfeb"}'])).first()
    assert row.name.startswith("a") and row.name.endswith("b")


def test_message_text(messages):
    rows = as_text(messages(["x", None])).collect()
    assert [tuple(r) for r in rows] == [("k", "x"), ("k", None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_payload_contract(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        decoded = payload_value(raw_payloads(spark, [p for p, _ in PAYLOADS]).coalesce(1))
        assert dict(decoded.dtypes)["value"] == "double"
        assert "payload" not in decoded.columns
        assert [r.value for r in decoded.collect()] == [v for _, v in PAYLOADS]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_event_time_parts(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [("m", stamp, "x", None, "1") for stamp, _ in STAMPS]
        parts = event_time_parts(spark.createDataFrame(rows, RAW).coalesce(1))
        got = [(r["@timestamp"], (r.year, r.month, r.day, r.hour)) for r in parts.collect()]
        assert got == STAMPS
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_fixture_averages(messages):
    raw = decode_envelope(messages([FULL, QUOTED, '{"name":"well_pump_rpm"}', "not json"]))
    got = {tuple(r) for r in hourly_avg(payload_value(raw), "well_pump_rpm").collect()}
    assert got == {
        ("7", "well_pump_rpm", 2021, 6, 1, 10, 2.0),
        (None, "well_pump_rpm", None, None, None, None, None),
    }


def test_reject_counts(spark):
    raw = raw_payloads(spark, [p for p, _ in PAYLOADS])
    (row,) = reject_counts(raw).collect()
    numbers = sum(v is not None for _, v in PAYLOADS)
    missing = sum(p is None for p, _ in PAYLOADS)
    assert (row.messages, row.rejected) == (len(PAYLOADS), len(PAYLOADS) - numbers - missing)


@pytest.mark.parametrize(
    ("payloads", "inferred"),
    [
        (['{"value":1.5}', '{"value":2}'], "DOUBLE"),
        (['{"value":6.0}'], "DOUBLE"),
        (['{"value":1}', '{"value":2}', '{"value":null}'], "BIGINT"),
        (['{"value":123456789012345678901234567890}', '{"value":1}'], "DECIMAL"),
        (['{"value":1.5}', '{"value":"1.5"}'], "STRING"),
        (['{"value":null}'], "STRING"),
        (['{"value":true}'], "BOOLEAN"),
        (['{"value":true}', '{"value":1}'], "STRING"),
        (['{"value":{"a":1}}'], "STRUCT"),
        (['{"value":[1]}'], "ARRAY"),
        (['{"value":1.5}', "oops", None, "[1]", "{}"], "DOUBLE"),
    ],
)
def test_payload_profile_settles_on_the_inferred_type(spark, payloads, inferred):
    rows = {r.field: r for r in payload_profile(raw_payloads(spark, payloads)).collect()}
    assert rows["value"].inferred_type == inferred
    without_field = sum(p is None or not p.startswith('{"') for p in payloads)
    assert (rows[None].messages if None in rows else 0) == without_field


def test_profile_counts_all_fields(spark):
    raw = raw_payloads(spark, ['{"value":1,"unit":"psi"}', '{"value":2.5,"unit":null}'])
    rows = {r.field: r.asDict() for r in payload_profile(raw).collect()}
    assert (rows["value"]["integers"], rows["value"]["fractions"]) == (1, 1)
    assert (rows["unit"]["texts"], rows["unit"]["messages"]) == (1, 2)


def test_profile_takes_the_last_of_a_repeated_field(spark):
    raw = raw_payloads(spark, ['{"value":1,"value":"x"}', '{"value":2}', "{}", None])
    rows = {r.field: r.asDict() for r in payload_profile(raw).collect()}
    value = rows["value"]
    assert (value["messages"], value["texts"], value["integers"]) == (2, 1, 1)
    assert rows[None]["messages"] == 2


def test_decoding_a_megabyte_text_whole(messages):
    text = "x" * 1_000_000
    row = decode_envelope(messages(['{"name":"%s"}' % text])).select(F.length("name")).first()
    assert row[0] == len(text)
