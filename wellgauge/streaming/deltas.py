"""Sums and counts per well, metric and hour, stored as deltas that are merged by size.

What a batch brings is written as a delta of its own, a folder per date named after the
batches it covers. So a late reading costs a row, however much its date holds already. The
next batches that touch a date merge those of its deltas that are of like size: one of ``n``
bytes is merged again only with newer ones of ``n / MERGE_FACTOR`` bytes together or more.
So what is merged grows by a constant factor each time, a byte is rewritten a number
of times that grows with the logarithm of its date, and as many deltas stay.

Only deltas of earlier batches are merged, which no failure brings back; a repeated batch
replaces its own. A merged delta is there as a whole or not at all. From then on the
deltas within its range of batches do not count, whether or not they are deleted yet.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellgauge.operators.averages import sum_partials
from wellgauge.sinks.folders import delete, size, subfolders
from wellgauge.sinks.tables import write_partials
from wellgauge.sources.tables import date_folder, read_partials_at

MERGE_FACTOR = 2


class Delta(NamedTuple):
    """What the batches ``first`` to ``last`` brought for a date."""

    first: int
    last: int
    folder: str


def write_delta(partials: DataFrame, batch_id: int, path: str) -> None:
    """Store what a batch brings; a repeated batch replaces what it wrote before."""
    write_partials(partials, F.lit(_range(batch_id, batch_id)), path)


def merge_deltas(
    spark: SparkSession, path: str, dates: Sequence[str | None], batch_id: int
) -> None:
    """Merge deltas of like size of some dates, of batches before ``batch_id`` only."""
    due, outdated = {}, []
    for date in dates:
        stored = deltas(spark, path, date)
        counting = live(stored)
        # A merge that broke off left these.
        outdated += [d.folder for d in stored if d not in counting]
        together = _of_like_size(spark, [d for d in counting if d.last < batch_id])
        if len(together) > 1:
            due[date] = together
    delete(spark, outdated)
    if not due:
        return
    names = [
        F.lit(text)
        for date, merged in due.items()
        for text in (date or "", _range(merged[0].first, merged[-1].last))
    ]
    folders = [d.folder for merged in due.values() for d in merged]
    sums = sum_partials(read_partials_at(spark, path, folders), "event_date")
    write_partials(sums, F.create_map(*names)[F.coalesce("event_date", F.lit(""))], path)
    delete(spark, folders)


def stored_sums(spark: SparkSession, path: str, dates: Sequence[str | None]) -> DataFrame:
    """Stored sums of some dates that have any: a row per group and delta."""
    folders = [d.folder for date in dates for d in live(deltas(spark, path, date))]
    return read_partials_at(spark, path, folders)


def deltas(spark: SparkSession, path: str, date: str | None) -> list[Delta]:
    """All deltas of a date, those within the range of another too."""
    folder = date_folder(path, date)
    found = []
    for name in subfolders(spark, folder):
        first, last = name.removeprefix("batches=").split("-")
        found.append(Delta(int(first), int(last), f"{folder}/{name}"))
    return found


def live(stored: Sequence[Delta]) -> list[Delta]:
    """The deltas that count, oldest first: those within the range of no other."""
    counting: list[Delta] = []
    for delta in sorted(stored, key=lambda d: (d.first, -d.last)):
        if not counting or delta.last > counting[-1].last:
            counting.append(delta)
    return counting


def _of_like_size(spark: SparkSession, stored: Sequence[Delta]) -> list[Delta]:
    """The newest deltas, back to the first that is too large to be merged with them."""
    if len(stored) < 2:
        return []
    total, since = size(spark, stored[-1].folder), len(stored) - 1
    while since > 0 and (older := size(spark, stored[since - 1].folder)) <= MERGE_FACTOR * total:
        total, since = total + older, since - 1
    return list(stored[since:])


def _range(first: int, last: int) -> str:
    return f"{first}-{last}"
