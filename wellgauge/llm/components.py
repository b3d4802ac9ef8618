"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellgauge.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the component
    is its smallest node. Nodes without a link do not occur.

    Each round points every node to the smallest of its neighbourhood, first from
    the side of larger neighbours, then of smaller ones, until all point to the
    root. Neighbourhoods are reduced to their minimum before the shuffle and never
    gathered; each round's links are written to the shared folder.
    """
    links = staged(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        links = staged(_small_star(_large_star(links)), "links")
        # Sums of the smaller ends only fall; a fixed point leaves all as they are.
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("a", "b")),
        ).first()
        if now == before:
            return (
                links.select(F.col("a").alias("node"), F.col("b").alias("component"))
                .unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("component")))
                .distinct()
            )
        before = now


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest neighbour."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("m"))
    return (
        both.filter("b > a")
        .join(lowest, F.col("a") == F.col("u"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest."""
    lowest = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = (
        links.join(lowest, F.col("a") == F.col("u"))
        .filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionAll(lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
