"""Batch forms of the two stages. None of them writes a path a stream writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from wellgauge.operators import as_text, curate, decode_nested, hourly_avg, payload_value
from wellgauge.sinks.folders import exists
from wellgauge.sinks.tables import append_table, overwrite_table, write_hourly
from wellgauge.sources.tables import ensure_hourly


def backfill(messages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write everything the log holds, one struct per message.

    Each call reads the log from its start. Overwriting makes that repeatable;
    ``mode="append"`` adds all messages once more.
    """
    write = {"overwrite": overwrite_table, "append": append_table}[mode]
    write(decode_nested(messages), path)


def dump_messages(messages: DataFrame, path: str) -> None:
    """Write keys and values as text, nothing decoded."""
    overwrite_table(as_text(messages), path)


def rebuild(raw: DataFrame, curated_path: str, hourly_path: str, metrics: Iterable[str]) -> None:
    """Curated copy and hourly averages from a whole raw table: one pass each.

    Both tables are replaced as a whole; hours that raw no longer has go. Neither
    path may be one that a stream writes; the sink log of a stream is looked for.
    """
    for path in (curated_path, hourly_path):
        if exists(raw.sparkSession, f"{path}/_spark_metadata"):
            raise ValueError(f"a stream writes {path}: rebuild to another path")
    overwrite_table(curate(raw), curated_path)
    write_hourly(hourly_avg(payload_value(raw), metrics), hourly_path, whole_table=True)
    ensure_hourly(raw.sparkSession, hourly_path)
