import gzip
import io

import pytest
from pyspark.sql import functions as F

from wellgauge.llm import warc
from wellgauge.session import workspace

PAGES = "page_id long, url string, html string"
LONG = "<p>" + "long " * 60_000
ROWS = [
    *[(i, f"http://x/{i}?a=b c", "a" * 150 if i % 3 else "short") for i in range(12)],
    (None, None, "a" * 150),
    (20, "u", None),
    (21, "\n", ""),
    (5, "again", "a" * 150),
    (1, "again", "a" * 150),
    (30, "u", "lines\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 5\n\n\r\n\r\n" * 9),
    (31, "ü 漢", LONG),
    (32, "v", LONG),
    (40, "w", "b" * 100),
    (41, "w", "b" * 100),
    (42, "w", "c" * 99),
    (43, "w", "c" * 99),
]


def converted(spark, pages, **options):
    path = workspace(spark, "warc")
    warc.write_warc(warc.legacy_archives(pages, **options), path)
    return warc.read_warc(spark, path)


def brute(rows):
    want = []
    for key, _, html in rows:
        payload = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == payload and k is not None]
        first = min(same, default=None)
        revisit = len(payload) >= 100 and key is not None and key > first
        want.append((key, len(payload), "revisit" if revisit else "response", first if revisit else None))
    return want


@pytest.mark.parametrize("size", [1, 700, 4 << 20])
def test_pages_through_archives_of_any_size(spark, size):
    pages = spark.createDataFrame(ROWS, PAGES).withColumn("key", F.lit("own"))
    found = converted(spark, pages, archive_bytes=size).collect()
    got = [
        (r.key and int(r.key), r.payload_bytes, r.record_type, r.refers_to and int(r.refers_to))
        for r in found
    ]
    assert sorted(got, key=str) == sorted(brute(ROWS), key=str)
    texts = {r.key: r.payload for r in found if r.record_type == "response"}
    assert texts["30"].decode() == ROWS[17][2] and texts["31"].decode() == LONG
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert {r.date for r in found} == {"2024-01-01T00:00:00Z"}


def test_both_versions_parse(spark):
    pages = spark.createDataFrame(ROWS, PAGES)
    archives = warc.legacy_archives(pages, archive_bytes=500).collect()
    versions = {bytes(a.content).split(b"\n")[1][:1] for a in archives}
    assert versions == {b"1", b"2"} and len(archives) > 4
    assert sum(len(list(warc.parse_arc(bytes(a.content)))) for a in archives) == len(ROWS)


def arc(version, records):
    data = warc.arc_opening(version, "t.arc", "20200102030405")
    for url, body in records:
        header = warc.arc_header(version, url, "1.2.3.4", "20200102030405", "text/html", len(data), len(body))
        data += header + body + b"\n"
    return data


@pytest.mark.parametrize("version", [1, 2])
def test_declared_lengths_rule(version):
    bodies = [b"\n\nhttp://x 0.0.0.0 2 t 3\nabc", b"", b"HTTP/1.0 200 OK\r\n\r\n\r\n\r\n"]
    data = arc(version, [(f"http://{i}", b) for i, b in enumerate(bodies)])
    found = list(warc.parse_arc(data))
    assert [r.body for r in found] == bodies and found[0].ip == "1.2.3.4"
    for wrong in (data[:-5], data[1:], data.replace(b"Archive-length", b"Archive-size  "), b"x"):
        with pytest.raises(ValueError):
            list(warc.parse_arc(wrong))
    assert list(warc.parse_arc(b"")) == []


def test_compressed_archives(spark):
    """One member a file, and one a record, give the records of the plain file."""
    pages = spark.createDataFrame(ROWS, PAGES)
    for archive in warc.legacy_archives(pages, archive_bytes=2000).collect():
        plain = bytes(archive.content)
        records = list(warc.parse_arc(plain))
        cuts = [0, *(r.offset for r in records), len(plain)]
        members = b"".join(
            gzip.compress(plain[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)
        )
        for packed in (gzip.compress(plain), members):
            assert list(warc.parse_arc(packed)) == records
            for wrong in (packed[:-9], packed[:20]):
                with pytest.raises(ValueError):
                    list(warc.parse_arc(wrong))


def test_other_records_and_identifiers(spark):
    data = arc(1, [("dns:x.org", b"20200102 x.org A 1.2.3.4"), ("http://x", b"plain")])
    path = workspace(spark, "warc")
    archives = spark.createDataFrame([("a.arc", data)], "path string, content binary")
    warc.write_warc(archives, path)
    found = warc.read_warc(spark, path).collect()
    assert [(r.record_type, bytes(r.payload)) for r in sorted(found, key=lambda r: r.url)] == [
        ("response", b"20200102 x.org A 1.2.3.4"),
        ("resource", b"plain"),
    ]
    assert len({r.record_id for r in found}) == 2 and {r.key for r in found} == {None}
    assert found[0].date == "2020-01-02T03:04:05Z"


def test_archives_without_keys(spark):
    """Records are known by URL, date and place; lengths of revisits are of the payload,
    whatever the server declared."""
    answers = [b"HTTP/1.0 200 OK\r\n\r\n", b"HTTP/1.0 200 OK\r\nContent-Length: 7\r\n\r\n"]
    same, other = b"s" * 120, b"o" * 120
    records = [("http://b", answers[0] + same), ("http://a/?x=%2F", answers[0] + same)]
    records += [("http://c", answers[1] + same), ("http://c", answers[1] + same)]
    records += [("http://d", answers[1] + other), ("http://e", b"tiny"), ("http://f", b"tiny")]
    path = workspace(spark, "warc")
    files = [("one.arc", arc(1, records[:3])), ("two.arc", arc(2, records[3:])), ("none.arc", None)]
    archives = spark.createDataFrame(files, "path string, content binary")
    warc.write_warc(archives, path, key_type="string", key_header=None)
    found = warc.read_warc(spark, path).collect()
    assert len(found) == 7 and len({r.key for r in found}) == 7
    first = next(r for r in found if r.url == "http://a/?x=%2F")
    assert first.record_type == "response" and bytes(first.payload) == same
    assert first.key.startswith("http://a/?x=%2F 20200102030405 one.arc#")
    revisits = [r for r in found if r.record_type == "revisit"]
    assert sorted(r.url for r in revisits) == ["http://b", "http://c", "http://c"]
    assert {r.refers_to for r in revisits} == {first.key}
    assert {r.payload_bytes for r in revisits} == {120}


def test_files_are_bounded_by_bytes(spark):
    pages = spark.createDataFrame([(i, "u", f"{i} " * 4000) for i in range(60)], PAGES).coalesce(1)
    path = workspace(spark, "warc")
    warc.write_warc(warc.legacy_archives(pages), path, file_bytes=160_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    sizes = [len(gzip.decompress(f.content)) for f in files]
    assert max(sizes) <= 161_000 and len(sizes) > 3
    assert warc.read_warc(spark, path).select("key").distinct().count() == 60


def test_files_are_warc(spark):
    path = workspace(spark, "warc")
    warc.write_warc(warc.legacy_archives(spark.createDataFrame(ROWS, PAGES)), path, per_file=3)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    records = 0
    for file in files:
        for fields, block in warc.parse_warc(io.BytesIO(gzip.decompress(file.content))):
            assert fields["content-length"] == str(len(block))
            assert fields["warc-type"] in ("response", "revisit")
            records += 1
    assert records == len(ROWS) and len(files) > 2


def test_no_pages(spark):
    assert converted(spark, spark.createDataFrame([], PAGES)).collect() == []
