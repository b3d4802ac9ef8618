"""The nested type of payloads, inferred from all of them.

Payload types are a contract and never depend on data (``decode``); this shows what the
payloads really hold: every field, those in objects and arrays too, with the type that all
its values agree on. Types are merged by Spark's own aggregate, partly before the shuffle,
so a name with most of the messages sends a type from each task and not its messages.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIXED = "MIXED"
_FIELDS = "name STRING, path STRING, kind STRING"

# A type is written as a name, its parts in angle brackets: OBJECT<a: BIGINT, ...>.
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[<>,:]|DECIMAL\(\d+,\d+\)|[^<>,:`\s]+")
_DECIMAL = re.compile(r"DECIMAL\((\d+),(\d+)\)")
_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_KINDS = {"VARIANT": MIXED, "VOID": "NULL"}


def payload_schema(raw: DataFrame, names: Iterable[str]) -> DataFrame:
    """``path`` and ``kind`` of every field of the payloads of each name; payloads of all
    other names, and without one, are those of the name NULL.

    Paths begin with ``$``; ``[]`` stands for all elements of an array. Kinds are those
    of JSON: OBJECT, ARRAY, STRING, BOOLEAN, NULL, and BIGINT, DOUBLE and DECIMAL
    (integers beyond BIGINT) for numbers. Where values differ in more than the size of a
    number the kind is MIXED, and what is below is not told apart. Payloads that are no
    JSON, or repeat a key, take no part.
    """
    name = F.when(F.col("name").isin(list(names)), F.col("name"))
    value = F.try_parse_json("payload")
    types = raw.groupBy(name.alias("name")).agg(F.schema_of_variant_agg(value).alias("type"))
    return types.filter("type <> 'VOID'").mapInArrow(_field_rows, _FIELDS)


def _field_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            {"name": name, "path": path, "kind": kind}
            for name, written in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for path, kind in fields_of(written)
        ]
        schema = pa.schema([(c, pa.string()) for c in ("name", "path", "kind")])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def fields_of(written: str) -> Iterator[tuple[str, str]]:
    """Path and kind of everything in a type, as Spark writes types of variants."""
    path, around, name_next = "$", [], False
    for token in _TOKEN.findall(written):
        if token == "<":
            continue
        if token == ">":
            around.pop()
            name_next = False
        elif token == ",":
            name_next = bool(around) and around[-1][0] == "OBJECT"
        elif token == ":":
            name_next = False
        elif name_next:
            path = f"{around[-1][1]}.{_key(token)}"
        else:
            yield path, _kind(token)
            if token in ("OBJECT", "ARRAY"):
                around.append((token, path))
                name_next = token == "OBJECT"
                path += "[]"


def _key(token: str) -> str:
    name = token[1:-1].replace("``", "`") if token.startswith("`") else token
    if _PLAIN.fullmatch(name):
        return name
    return '"' + name.replace('"', '\\"') + '"'


def _kind(token: str) -> str:
    decimal = _DECIMAL.fullmatch(token)
    if decimal is None:
        return _KINDS.get(token, token)
    whole = decimal[2] == "0" and int(decimal[1]) > 18
    return "DECIMAL" if whole else "DOUBLE"
