"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered in the order of their keys, the numbers are permuted, and the place
``p`` of a row gives shard ``p % shards`` and slot ``p // shards``. So shards differ by
one row at most, slots have no gaps, and where a row goes follows from its number, the
number of rows and the seed alone, as does which row a slot holds.

NULL keys sort first. Rows that agree in all keys share their numbers among
themselves in any order; give more keys to tell them apart. An empty table stays
empty. Other columns are kept, those named ``shard`` or ``slot`` replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellgauge.llm.common import numbered, quoted
from wellgauge.llm.feistel import invert, permute, permuted

# Rows are sorted within so many groups; more than a cluster has cores.
BUCKETS = 4096


def shard_rows(
    rows: DataFrame, keys: Sequence[str], shards: int, seed: int, buckets: int = BUCKETS
) -> DataFrame:
    """Add ``shard`` and ``slot``. The shuffle moves all columns of ``rows``: pass
    what is needed."""
    rows = rows.drop("shard", "slot")
    n = rows.count()
    order = [F.col(quoted(k)) for k in keys]
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets))
    placed = numbered(rows, bucket, order, buckets).select(
        "row", permuted(F.col("number"), max(n, 1), seed).alias("place")
    )
    return placed.select(
        "row.*",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("place"), F.lit(shards)).alias("slot"),
    )


def place_of(number: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    place = permute(number, n, seed)
    return place % shards, place // shards


def number_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Row number at a slot of a shard."""
    return invert(slot * shards + shard, n, seed)
