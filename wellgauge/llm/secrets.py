"""Secret scans with structural confirmation.

Patterns find assignments, access ids and long hexadecimal runs. Beyond these,
base64 and hexadecimal candidates are decoded and reported only if they parse: a
private key in DER, whose nested lengths must fill the whole, an OpenSSH key
container with its chain of length-prefixed strings, or a signed token whose header
is a JSON object that names an algorithm.

Spans are code points, end exclusive. NULL and empty texts hold no secret; repeated
rows are scanned each by itself, and a text of any length is scanned whole. A
candidate in base64 may begin with any line and ends where the lengths it declares say;
lines may be indented, and lines of other text may precede and follow. One that is cut
off, padded wrongly or followed by further bytes in its last line is no key.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from wellgauge.llm.common import changed_rows, text_slices, texts_of

# Patterns of plain secrets and the least length that counts.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
# A run is matched as a whole, so the least length can stand in the pattern.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# Order of kinds where spans start together.
KINDS = ("assign", "access", "hex", "der", "ssh", "signed")

_ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
_BASE64_LEAST = 24  # of a key's first line
_BASE64 = re.compile(r"[A-Za-z0-9+/]+")
_BASE64_LINES = re.compile(
    r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{24,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/]+)*"
)
_PADDING = re.compile("={0,2}")
# How a DER sequence and an OpenSSH container begin.
_KEY_STARTS = ("M", "b3BlbnNzaC1rZXktdjEA")
_HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")


class Span(NamedTuple):
    start: int
    end: int
    kind: str


# --- structures -----------------------------------------------------------------


class _Element(NamedTuple):
    tag: int
    body: bytes


_SEQUENCE, _INTEGER, _BITS, _OCTETS, _OID = 0x30, 0x02, 0x03, 0x04, 0x06


def der_elements(data: bytes) -> list[_Element] | None:
    """Elements that fill ``data`` exactly, by their declared lengths; else None."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length >= 0x80:
            count = length & 0x7F
            if not 1 <= count <= 4 or at + count > len(data):
                return None
            length = int.from_bytes(data[at : at + count], "big")
            at += count
        if at + length > len(data):
            return None
        found.append(_Element(tag, data[at : at + length]))
        at += length
    return found


def _small(element: _Element) -> int | None:
    """Value of an integer of one byte."""
    is_small = element.tag == _INTEGER and len(element.body) == 1
    return element.body[0] if is_small else None


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are one private key in DER."""
    outer = der_elements(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    parts = der_elements(outer[0].body)
    if not parts:
        return False
    tags = [p.tag for p in parts]
    version = _small(parts[0])
    if set(tags) == {_INTEGER} and all(p.body for p in parts):
        # Version, then numbers: nine of an RSA key, six of a DSA key.
        return version == 0 and len(parts) in (6, 9) and len(parts[1].body) >= 32
    if tags[:3] == [_INTEGER, _SEQUENCE, _OCTETS] and version in (0, 1):
        return _names_algorithm(parts[1]) and bool(parts[2].body)
    if tags[:2] == [_INTEGER, _OCTETS] and version == 1:  # an elliptic curve's scalar
        curve = [der_elements(p.body) for p in parts[2:] if p.tag in (0xA0, 0xA1)]
        return len(parts) > 2 and len(curve) == len(parts) - 2 and all(curve)
    if tags == [_SEQUENCE, _OCTETS]:  # encrypted
        return _names_algorithm(parts[0]) and len(parts[1].body) >= 32
    return False


def _names_algorithm(element: _Element) -> bool:
    parts = der_elements(element.body)
    return bool(parts) and parts[0].tag == _OID and bool(parts[0].body)


_SSH_MAGIC = b"openssh-key-v1\0"


def is_ssh_container(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH key file, by its nested lengths."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        length = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + length > len(data):
            return None
        at += 4 + length
        return data[at - length : at]

    cipher, kdf, options = string(), string(), string()
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not cipher or not kdf or options is None or not keys:
        return False
    # As many public keys as declared, then the private part; none of them is empty.
    return all(string() for _ in range(keys + 1)) and at == len(data)


def is_signed_token(header: str, payload: str) -> bool:
    """Whether both parts are JSON objects and the header names an algorithm."""
    try:
        first, second = (
            json.loads(base64.urlsafe_b64decode(p + "=" * (-len(p) % 4))) for p in (header, payload)
        )
    except (ValueError, RecursionError):
        return False
    is_header = isinstance(first, dict) and isinstance(first.get("alg"), str)
    return is_header and isinstance(second, dict)


def _declared(data: Callable[[int, int], bytes]) -> int:
    """Bytes that a key has by the lengths it declares; 0 if it declares none.
    ``data`` gives the bytes from an offset on, as many as asked for or there are."""
    head = data(0, 6)
    if head[:1] == b"\x30":
        length = head[1] if len(head) > 1 else 0x80
        if length < 0x80:
            return 2 + length
        count = length & 0x7F
        if not 1 <= count <= 4 or len(head) < 2 + count:
            return 0
        return 2 + count + int.from_bytes(head[2 : 2 + count], "big")
    at = len(_SSH_MAGIC)
    if data(0, at) != _SSH_MAGIC:
        return 0
    for _ in range(3):
        at += 4 + int.from_bytes(data(at, 4), "big")
    keys = int.from_bytes(data(at, 4), "big")
    at += 4
    if not keys:
        return 0
    # No part is empty, so a count that is too large ends with the text.
    for _ in range(keys + 1):
        length = int.from_bytes(data(at, 4), "big") if len(data(at, 4)) == 4 else 0
        if not length:
            return 0
        at += 4 + length
    return at


def _kind(data: bytes) -> str | None:
    return "der" if is_private_key(data) else "ssh" if is_ssh_container(data) else None


def _base64_keys(text: str) -> Iterator[Span]:
    """Keys that begin with a line and end where one ends."""
    for block in _BASE64_LINES.finditer(text):
        lines = list(_BASE64.finditer(text, *block.span()))
        if not any(line[0].startswith(_KEY_STARTS) for line in lines):
            continue
        letters = "".join(line[0] for line in lines)
        ends = list(accumulate(len(line[0]) for line in lines))  # in letters
        free = 0  # lines before are part of a key
        for i, line in enumerate(lines):
            if i < free or len(line[0]) < _BASE64_LEAST or not line[0].startswith(_KEY_STARTS):
                continue
            start = ends[i] - len(line[0])

            def data(at: int, count: int, start: int = start) -> bytes:
                first = at // 3 * 4
                some = letters[start + first : start + first + (count + 2) // 3 * 4 + 4]
                some = some[: len(some) - (len(some) % 4 == 1)]
                return base64.b64decode(some + "=" * (-len(some) % 4))[at % 3 :][:count]

            size = _declared(data)
            stop = start + (size * 4 + 2) // 3
            last = bisect_left(ends, stop)
            if not size or last == len(ends) or ends[last] != stop:
                continue
            end = _PADDING.match(text, lines[last].end()).end()
            padding = end - lines[last].end()
            if padding and (stop - start + padding) % 4:
                continue
            if kind := _kind(data(0, size)):
                yield Span(line.start(), end, kind)
                free = last + 1


def _hex_keys(text: str) -> Iterator[Span]:
    for match in _HEX_BYTES.finditer(text):
        if kind := _kind(bytes.fromhex(match[0])):
            yield Span(*match.span(), kind)


# --- scanning -------------------------------------------------------------------


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, by start and kind."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in _ASSIGN_HINTS):
        for match in ASSIGN.finditer(text):
            if len(match[1]) >= ASSIGN_LEAST:
                found.append(Span(*match.span(), "assign"))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if len(match[0]) >= ACCESS_LEAST:
                found.append(Span(*match.span(), "access"))
    found += [Span(*match.span(), "hex") for match in HEX.finditer(text)]
    return ordered(found)


def structural_spans(text: str) -> list[Span]:
    """Spans that decode and parse, by start and kind."""
    found = [
        *_base64_keys(text),
        *_hex_keys(text),
    ]
    if "." in text:
        for match in _SIGNED.finditer(text):
            if is_signed_token(match[1], match[2]):
                found.append(Span(*match.span(), "signed"))
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with a mark in place of each stretch of overlapping spans."""
    out, at = [], 0
    for span in spans:
        if span.start >= at:
            out += [text[at : span.start], f"[{span.kind} secret]"]
        at = max(at, span.end)
    return "".join([*out, text[at:]])


# --- Spark ----------------------------------------------------------------------

_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
)


def _as_arrow(rows: list[list[Span]]) -> pa.Array:
    return pa.array(
        [[{"kind": s.kind, "start": s.start, "end": s.end} for s in spans] for spans in rows], _SPANS
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``base`` and ``structural``, arrays of kind, start and end."""
    kind = docs.schema[id_column].dataType.simpleString()
    spans = "array<struct<kind:string,start:int,end:int>>"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_column):
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch, text_column)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    _as_arrow([base_spans(t) for t in texts]),
                    _as_arrow([structural_spans(t) for t in texts]),
                ],
                names=[id_column, "base", "structural"],
            )

    return docs.select(id_column, text_column).mapInArrow(
        rows, f"`{id_column}` {kind}, base {spans}, structural {spans}"
    )


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with all their columns, secrets in the text replaced by marks. A
    text without a secret, NULL included, stays as it is, byte for byte; one with a secret
    gets replacement characters for bytes that are no UTF-8."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_column):
            column = batch.column(text_column)
            texts = column.cast(pa.binary()).to_pylist()
            for i, raw in enumerate(texts):
                text = raw.decode("utf-8", "replace") if raw else ""
                if spans := ordered(base_spans(text) + structural_spans(text)):
                    texts[i] = redacted(text, spans).encode()
            at = batch.schema.get_field_index(text_column)
            # Seen as text and not cast to it, which would refuse bytes that are none.
            marked = pa.array(texts, pa.binary()).view(pa.string()).cast(column.type)
            yield batch.set_column(at, text_column, marked)

    return changed_rows(docs, rows)
