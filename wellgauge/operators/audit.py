"""Whether a copy holds the same rows, without a join.

A table is summed up in three numbers: rows, the sum of their hashes and the exclusive or
of their hashes. They do not depend on order or layout, repeated rows count as often as
they are there, and one changed, missing or added row changes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checksums(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``rows``, ``hash_sum`` and ``hash_xor`` of all columns, for each value of ``by``.
    Summed before the shuffle: a row from each task and group."""
    digest = row_hash(table)
    return table.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0)).alias("hash_sum"),
        F.coalesce(F.bit_xor(digest), F.lit(0)).alias("hash_xor"),
    )


def row_hash(table: DataFrame) -> Column:
    """Hash of a row. NULLs are hashed as values of their own: by itself the hash skips
    them, so a value that moved to the next column would go unseen."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in table.columns]
    return F.xxhash64(*[part for c in columns for part in (c.isNull(), c)])


def same_rows(copy: DataFrame, original: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For each value of ``by``: rows of both tables, and whether they are the same. The
    tables need the same columns; each is read once."""
    both = (
        checksums(copy, by).withColumn("side", F.lit(1))
        .unionByName(checksums(original.select(*copy.columns), by).withColumn("side", F.lit(2)))
    )

    def of(side: int, name: str) -> Column:
        found = F.max(F.when(F.col("side") == side, F.col(name)))
        return F.coalesce(found, F.lit(0))

    names = ("rows", "hash_sum", "hash_xor")
    sums = both.groupBy(*by).agg(*[of(s, n).alias(f"{n}_{s}") for s in (1, 2) for n in names])
    same = [F.col(f"{n}_1") == F.col(f"{n}_2") for n in names]
    return sums.select(
        *by,
        F.col("rows_1").alias("copied"),
        F.col("rows_2").alias("original"),
        (same[0] & same[1] & same[2]).alias("same"),
    )
