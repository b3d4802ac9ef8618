"""Legacy web archives (ARC, versions 1 and 2) to WARC.

An ARC file opens with a version block that names the fields of its header lines; each
record is one such line, as many bytes as the line declares, and a line feed. Records
are found by these lengths alone. From a record the converter makes the WARC
equivalents: identifier, timestamp, record type, payload and block digests.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest
key is written as a response and the others as revisits of it, without the payload.
Records with equal keys and payloads are of one type. The key stands in a header of the
record; where archives have no such header, the URL, date and place of a record can be its
key. A record without a key is identified by its archive and offset, is always written in
full, and is nobody's original. Empty payloads are responses of length zero.

Archives may be compressed, as a whole or record by record. An archive that is cut off or
whose lengths do not add up ends the job.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header lines of both versions, and the record separator of WARC.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: (
        "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
        "Filename Archive-length"
    ),
}
SEPARATOR = "\r\n\r\n"
KEY_HEADER = "X-Record-Key"
SIZE_HEADER = "X-Payload-Length"
_GZIP = b"\x1f\x8b"
_URN = "urn:arc-record:"


# --- ARC ------------------------------------------------------------------------


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    mime: str
    offset: int
    body: bytes


def arc_header(version: int, url: str, ip: str, date: str, mime: str, offset: int, size: int) -> bytes:
    """One header line; white space in a URL is escaped, since it parts the fields."""
    url = re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) or "-"
    extra = f" 200 - - {offset} -" if version == 2 else ""
    return f"{url} {ip} {date} {mime}{extra} {size}\n".encode()


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The version block of a file."""
    block = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    return arc_header(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", 0, len(block)) + block


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """All records of a file but the version block. A file of gzip members, one for each
    record or for any stretch of the file, is read as what they hold; offsets count there."""
    if data.startswith(_GZIP):
        try:
            data = gzip.decompress(data)
        except (EOFError, zlib.error) as error:
            raise ValueError("a member of the archive is cut off or damaged") from error
    at = 0

    def line() -> str:
        nonlocal at
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no header line at byte {at}")
        text = data[at:end].decode("utf-8", "replace")
        at = end + 1
        return text

    if not data:
        return
    opening = line().split(" ")
    if not opening[0].startswith("filedesc://"):
        raise ValueError("an archive opens with its version block")
    block = data[at : at + int(opening[-1])].decode("utf-8", "replace").splitlines()
    at += int(opening[-1])
    version, fields = int(block[0].split(" ")[0]), block[1].split(" ")
    if FIELDS.get(version) != " ".join(fields):
        raise ValueError(f"unknown header line of version {version}")
    while at < len(data):
        if data[at] == 0x0A:  # between records
            at += 1
            continue
        start = at
        # Only the URL, the first field, may hold more blanks than there should be.
        values = dict(zip(reversed(fields), reversed(line().rsplit(" ", len(fields) - 1)), strict=True))
        size = int(values["Archive-length"])
        if at + size > len(data):
            raise ValueError(f"the record at byte {start} is cut off")
        yield ArcRecord(
            values["URL"], values["IP-address"], values["Archive-date"], values["Content-type"],
            start, data[at : at + size],
        )
        at += size


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """Header of an HTTP response with the blank line, and its payload; what is no
    HTTP response is payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    end = body.find(b"\r\n\r\n")
    return (body, b"") if end < 0 else (body[: end + 4], body[end + 4 :])


def http_header(head: bytes, name: str) -> str | None:
    match = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return match[1].decode("utf-8", "replace") if match else None


def legacy_archives(
    pages: DataFrame,
    key_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    date: str = "20240101000000",
    archive_bytes: int = 4 << 20,
) -> DataFrame:
    """Pages as ARC files of about ``archive_bytes``: ``path`` and ``content``, as
    Spark's reader of binary files gives them. Files of both versions take turns.
    NULL pages are empty."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([b"".join(parts)], pa.binary())], ["path", "content"]
            )

        for batch in batches:
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not parts:
                    version, name = 1 + (part + number) % 2, f"pages-{part:05}-{number:05}.arc"
                    parts = [arc_opening(version, name, date)]
                    size = len(parts[0])
                payload = html or b""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n"
                head += f"{KEY_HEADER}: {key}\r\n\r\n" if key is not None else "\r\n"
                body = head.encode() + payload
                line = arc_header(version, url or "", "0.0.0.0", date, "text/html", size, len(body))
                parts += [line, body, b"\n"]
                size += len(line) + len(body) + 1
                if size >= archive_bytes:
                    yield finished()
                    number, parts = number + 1, []
        if parts:
            yield finished()

    rows = pages.select(
        F.col(key_column).cast("string"), url_column, F.col(html_column).cast("binary")
    )
    return rows.mapInArrow(files, "path string, content binary")


# --- conversion -----------------------------------------------------------------

_RECORDS = "key string, source string, url string, ip string, date string, mime string, digest string, size long, head binary, payload binary"


def arc_records(
    archives: DataFrame, payloads: bool = True, key_header: str | None = KEY_HEADER
) -> DataFrame:
    """Records of archives, read from ``path`` and ``content``. Without payloads, the
    columns ``head`` and ``payload`` are NULL. Without ``key_header``, a record's key is
    its URL, date, archive and offset."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(
                batch.column("path").to_pylist(), batch.column("content"), strict=True
            ):
                found = []
                for record in parse_arc(content.as_buffer().to_pybytes() if content.is_valid else b""):
                    head, payload = split_http(record.body)
                    source = f"{path}#{record.offset}"
                    if key_header is None:
                        key = f"{record.url} {record.date} {source}"
                    else:
                        key = http_header(head, key_header)
                    found.append(
                        {
                            "key": key,
                            "source": source,
                            "url": record.url,
                            "ip": record.ip,
                            "date": record.date,
                            "mime": record.mime,
                            "digest": hashlib.sha256(payload).hexdigest(),
                            "size": len(payload),
                            "head": head if payloads else None,
                            "payload": payload if payloads else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(found, schema=_RECORD_SCHEMA)

    return archives.select("path", "content").mapInArrow(rows, _RECORDS)


_RECORD_SCHEMA = pa.schema(
    [(n, pa.string()) for n in ("key", "source", "url", "ip", "date", "mime", "digest")]
    + [("size", pa.int64()), ("head", pa.binary()), ("payload", pa.binary())]
)


def revisits(records: DataFrame, least: int = 100, key_type: str = "long") -> DataFrame:
    """``key``, ``digest`` and ``original``: records to be written as revisits, with
    the smallest key (compared as ``key_type``) of the same payload."""
    keyed = records.select("key", F.col("key").cast(key_type).alias("typed"), "digest", "size")
    keyed = keyed.filter((F.col("size") >= least) & F.col("typed").isNotNull())
    originals = keyed.groupBy("digest").agg(
        F.min("typed").alias("first"), F.min_by("key", "typed").alias("original")
    )
    return (
        keyed.join(originals, "digest")
        .filter(F.col("typed") > F.col("first"))
        .select("key", "digest", "original")
        .distinct()
    )


def warc_record(row: dict) -> bytes:
    """A WARC record without the separator that follows it."""
    revisit, head, payload = row["original"] is not None, row["head"], row["payload"]
    block = head if revisit else head + payload
    stamp = re.sub(r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d).*", r"\1-\2-\3T\4:\5:\6Z", row["date"])
    if revisit:
        kind = "revisit"
    else:
        kind = "response" if head or row["url"].startswith("dns:") else "resource"
    mime = "application/http; msgtype=response" if head else row["mime"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(row['key'], row['source'])}",
        f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {row['url']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(row['original'], '')}",
            f"{SIZE_HEADER}: {row['size']}",
        ]
    lines += [f"Content-Type: {mime}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def record_id(key: str | None, source: str) -> str:
    """Identifier of a record; the same record has the same one in every run."""
    name = quote(key, "") if key is not None else "at:" + hashlib.sha256(source.encode()).hexdigest()
    return f"<{_URN}{name}>"


def write_warc(
    archives: DataFrame,
    path: str,
    least: int = 100,
    key_type: str = "long",
    key_header: str | None = KEY_HEADER,
    per_file: int = 20_000,
    file_bytes: int = 64 << 20,
) -> None:
    """Convert archives to gzipped WARC files of at most ``per_file`` records and about
    ``file_bytes`` before compression; only a record that is longer than an eighth of that
    may make a file larger. Without ``key_header`` the key is text, which is also to be
    its ``key_type``.

    Archives are parsed twice: for digests, which alone are compared over the whole
    table, and for the records, which meet what is to be a revisit by their keys.
    """
    repeated = revisits(arc_records(archives, False, key_header), least, key_type)
    records = arc_records(archives, True, key_header).join(repeated, ["key", "digest"], "left")
    # The writer counts rows, so a row is a stretch of records of a bounded size.
    stretches = min(8, per_file)
    most, limit = per_file // stretches, file_bytes // stretches

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separator, held, size = SEPARATOR.encode(), [], 0

        def stretch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([separator.join(held)], pa.binary())], names=["records"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                record = warc_record(batch.slice(i, 1).to_pylist()[0])
                if held and (len(held) == most or size + len(record) > limit):
                    yield stretch()
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield stretch()

    (
        records.mapInArrow(rows, "records binary")
        # The text writer passes bytes on as they are; WARC ends a record by two
        # line breaks, which is what it puts after each row.
        .select(F.col("records").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", stretches)
        .text(path)
    )


# --- reading --------------------------------------------------------------------


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of gzipped WARC files: ``record_id``, ``record_type``, ``url``, ``date``,
    ``key``, ``payload_bytes`` and ``payload_digest`` (both of the full payload, also of
    revisits), ``refers_to`` (a key) and ``payload`` (NULL for revisits). Payloads that
    do not fit their digest end the job."""
    names = ["record_id", "record_type", "url", "date", "key", "payload_digest", "refers_to"]
    schema = pa.schema(
        [(n, pa.string()) for n in names] + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = pa.BufferReader(content.as_buffer())
                found, held = [], 0
                for fields, block in parse_warc(io.BufferedReader(gzip.GzipFile(fileobj=data))):
                    found.append(_as_row(fields, block))
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)
                        found, held = [], 0
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(
        rows, ", ".join(f"{n} string" for n in names) + ", payload_bytes long, payload binary"
    )


def _as_row(fields: dict[str, str], block: bytes) -> dict:
    is_http = fields["content-type"].startswith("application/http")
    head, payload = split_http(block) if is_http else (b"", block)
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    size: int | None = len(payload)
    if fields["warc-type"] == "revisit":
        declared = fields.get(SIZE_HEADER.lower()) or http_header(head, "Content-Length")
        payload, size = None, int(declared) if declared else None
    elif hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not fit its digest")
    return {
        "record_id": fields["warc-record-id"],
        "record_type": fields["warc-type"],
        "url": fields["warc-target-uri"],
        "date": fields["warc-date"],
        "key": _key_of(fields["warc-record-id"]),
        "payload_digest": digest,
        "refers_to": _key_of(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload": payload,
    }


def _key_of(identifier: str | None) -> str | None:
    """The key that an identifier is made of; none if it is made of a place."""
    name = identifier.strip("<>").removeprefix(_URN) if identifier else "at:"
    return None if name.startswith("at:") else unquote(name)
