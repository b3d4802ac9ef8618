"""Messages with the rows they must give."""

import json

FULL = (
    '{"@metadata":{"beat":"x"},"@timestamp":"2021-06-01T10:15:00.000Z",'
    '"name":"well_pump_rpm","payload":{"value":1.5},"well_id":7}'
)
QUOTED = (
    '{"@metadata":"m","@timestamp":"2021-06-01T10:45:00.000Z",'
    '"name":"well_pump_rpm","payload":"{\\"value\\": 2.5}","well_id":"7"}'
)
NOTHING = (None,) * 5

ENVELOPES = [
    (FULL, ('{"beat":"x"}', "2021-06-01T10:15:00.000Z", "well_pump_rpm", '{"value":1.5}', "7")),
    (QUOTED, ("m", "2021-06-01T10:45:00.000Z", "well_pump_rpm", '{"value": 2.5}', "7")),
    ('{"name":"well_pump_rpm"}', (None, None, "well_pump_rpm", None, None)),
    ('{"well_id":7.50}', (None, None, None, None, "7.5")),
    ('{"name":"x"} trailing', (None, None, "x", None, None)),
    ('{"name":"a","name":"b"}', (None, None, "b", None, None)),
    ("{'name':'q'}", (None, None, "q", None, None)),
    *[
        (junk, NOTHING)
        for junk in [
            "not json",
            '{"name":"x"',
            "5",
            '"a"',
            "null",
            "[]",
            "[1,2]",
            '[{"name":"a"}]',
            '[{"name":"a"},{"name":"b"}]',
            "{}",
            '{"NAME":"x","extra":1}',
            "",
            "   ",
            None,
        ]
    ],
]

PAYLOADS = [
    ('{"value":1.5}', 1.5),
    ('{"value":3}', 3.0),
    ('{"value":1e3}', 1000.0),
    ('{"value":"n/a"}', None),
    ('{"value":"2.5"}', None),
    ('{"value":true}', None),
    ('{"value":null}', None),
    ('{"value":{"a":1}}', None),
    ('{"value":[1]}', None),
    ('[{"value":4}]', None),
    ('{"Value":4}', None),
    ("oops", None),
    (None, None),
    ('{"value":"NaN"}', None),
    ('{"value":NaN}', None),
    ('{"value":"Infinity"}', None),
    ('{"value":-INF}', None),
    ('{"value":1e400}', None),
]

STAMPS = [
    ("2021-01-01T01:15:00.000Z", (2021, 1, 1, 1)),
    ("2021-01-01T01:15:00+05:00", (2020, 12, 31, 20)),
    ("2021-01-01 23:59:59.999999", (2021, 1, 1, 23)),
    ("2021-06", (2021, 6, 1, 0)),
    ("160945", (160945, 1, 1, 0)),
    ("garbage", (None,) * 4),
    ("10:15", (None,) * 4),
    ("T10:15:00", (None,) * 4),
    ("2021-01-01T99:99", (None,) * 4),
    ("2021-02-30T10:00:00Z", (None,) * 4),
    ("", (None,) * 4),
    (None, (None,) * 4),
]


def message(name="well_pump_rpm", well="7", stamp="2021-06-01T10:15:00.000Z", value=1.0, **more):
    """One sensor message; ``payload`` replaces the usual payload text."""
    payload = more.pop("payload", json.dumps({"value": value}))
    return json.dumps(
        {"@metadata": "m", "@timestamp": stamp, "name": name, "payload": payload, "well_id": well}
    )
