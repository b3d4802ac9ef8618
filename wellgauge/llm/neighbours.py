"""Approximate nearest neighbours by multiprobe p-stable hashing.

A hash is ``floor((a . x + b) / w)`` with Gaussian ``a`` and uniform ``b``; a table's
bucket is several of them. A query visits its own bucket and those that one step up or
down in some hashes leads to, in the order of their estimated success: the sum of
squares of the steps' distances from the query to the bucket walls. Every row that lies
in a visited bucket of any table is a candidate, once, and candidates are ranked by exact
distances.

The index is fitted on a bounded sample: of several numbers of tables, hashes and probes,
and of several bucket widths, the one is taken that visits the smallest share of pairs
while it finds ``target_recall`` of the sample's own nearest rows (``fit``). Of a tenth of
the rows the nearest one stands for the ten nearest of all.
How small the share is depends on the data: where near rows are much nearer than others
it is below a hundredth, where all are about as far apart nearly all have to be visited.
Every row is hashed. Queries go in blocks of bounded size to all tasks, which make the keys of the
buckets to visit; rows stay where they are and are read once per block: no bucket is
gathered anywhere, however full it is. A task keeps the best of each query and hands on
these alone. What a block finds is stored before the next one is sent, so the driver and
the tasks hold one block of vectors at a time, however many queries there are. Queries
that find fewer rows than there are to find are searched over all rows.

Vectors that are NULL, zero, or hold NULL or non-finite components take no part; rows
with NULL as id neither. Vectors of each size are searched by themselves. Only the
query's own row is not its neighbour: repeated rows and ids count each by itself, and an
id that stands in several rows is asked once for each of them. Equal distances go to the
smaller id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellgauge.llm.common import staged
from wellgauge.session import workspace

_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd
_PAIRS = 1 << 15  # distances computed at a time
_ROWS = 512


class Tables:
    """Hash functions of all tables, made from a seed."""

    def __init__(self, size: int, width: float, tables: int, hashes: int, seed: int):
        if hashes > 8:
            raise ValueError("at most 8 hashes: all steps of a bucket are weighed")
        rng = np.random.default_rng(seed)
        self.tables, self.hashes = tables, hashes
        self.directions = rng.standard_normal((size, tables * hashes)) / width
        self.offsets = rng.random(tables * hashes)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Of each vector, table and hash: the bucket number with its fraction."""
        found = vectors @ self.directions + self.offsets
        return found.reshape(len(vectors), self.tables, self.hashes)

    def keys(self, buckets: np.ndarray) -> np.ndarray:
        """One number per table and bucket. Buckets that share one by chance only add
        candidates."""
        numbers = buckets.astype(np.int64).view(np.uint64)  # rows, tables, hashes
        key = np.tile(np.arange(1, self.tables + 1, dtype=np.uint64), (len(numbers), 1))
        for i in range(self.hashes):
            key = (key ^ numbers[..., i]) * _MIX
            key = key ^ (key >> np.uint64(31))
        return key

    def probes(self, queries: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the ``count`` most promising buckets of each query and table, and
        the number of the query that each belongs to, sorted by key."""
        places = self.places(queries)
        buckets = np.floor(places)
        inside = places - buckets
        steps = np.array(list(product((0, -1, 1), repeat=self.hashes)))
        count = min(count, len(steps))
        keys, owners = [], []
        for q in range(len(queries)):
            down, up = inside[q] ** 2, (1 - inside[q]) ** 2
            cost = down @ (steps == -1).T + up @ (steps == 1).T
            best = np.argpartition(cost, count - 1, axis=1)[:, :count]
            visited = buckets[q][:, None, :] + steps[best]
            keys.append(self.keys(visited.transpose(1, 0, 2)).ravel())
            owners.append(np.full(keys[-1].size, q, np.int32))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        return key[order], owner[order]


@dataclass(frozen=True)
class Fit:
    """A setting, and what it did on the sample it was chosen on."""

    hashing: Tables
    probes: int
    recall: float
    visited: float  # share of the pairs of a query and a row


# Tables, hashes and probes of a table; bucket widths as shares of the median distance.
_SETTINGS = ((16, 8, 32), (16, 8, 96), (32, 6, 32), (32, 6, 64), (32, 6, 128), (32, 6, 192))
_WIDTHS = (0.1, 0.2, 0.3, 0.45, 0.7)
_TRIED = 48  # queries on the sample


def fit(points: np.ndarray, k: int, target_recall: float, seed: int) -> Fit:
    """The setting for a sample: the fewest pairs visited at the recall asked for, or
    the best recall if none has it."""
    n = min(_TRIED, len(points))
    apart = np.array([distances(points, p) for p in points[:n]])
    positive = apart[apart > 0]
    scale = float(np.median(positive)) if positive.size else 1.0
    apart[np.arange(n), np.arange(n)] = np.inf
    k = max(1, min(k, len(points) - 1))
    # All rows as near as the k-th; of equal ones any k will do.
    reach = np.partition(apart, k - 1, axis=1)[:, k - 1 : k] if len(points) > 1 else apart
    near = apart <= reach
    best = None
    for tables, hashes, probes in _SETTINGS:
        for width in _WIDTHS:
            hashing = Tables(points.shape[1], width * scale, tables, hashes, seed)
            keys, owners = hashing.probes(points[:n], probes)
            seen = _candidates(hashing, keys, owners, points, n).T
            seen[np.arange(n), np.arange(n)] = False
            found = np.minimum((seen & near).sum(axis=1), k).sum() / (n * k)
            made = Fit(hashing, probes, float(found), float(seen.mean()))
            if best is None or _better(made, best, target_recall):
                best = made
            if found >= target_recall:
                break  # wider buckets only hold more
    return best


def _better(a: Fit, b: Fit, target: float) -> bool:
    if a.recall < target or b.recall < target:
        return a.recall > b.recall
    return a.visited < b.visited


class Best:
    """The ``k`` nearest rows of each query so far, in bounded memory."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.worst = np.full(queries, np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def offer(self, query: np.ndarray, row: np.ndarray, distance: np.ndarray) -> None:
        near = distance <= self.worst[query]
        if near.any():
            self.parts.append((query[near], row[near], distance[near]))
            self.held += int(near.sum())
            if self.held > 1 << 18:
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, row, distance = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((row, distance, query))
        query, row, distance = query[order], row[order], distance[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        last = rank == self.k - 1
        self.worst[query[last]] = distance[last]
        self.parts = [(query[kept], row[kept], distance[kept])]
        self.held = int(kept.sum())
        return self.parts[0]


def distances(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - queries) ** 2).sum(axis=1))


def _candidates(tables: Tables, keys: np.ndarray, owners: np.ndarray, rows: np.ndarray, n: int):
    """Whether each query visits a bucket of each row."""
    found = np.zeros((len(rows), n), bool)
    own = tables.keys(np.floor(tables.places(rows)))
    for t in range(tables.tables):
        first = np.searchsorted(keys, own[:, t], "left")
        count = np.searchsorted(keys, own[:, t], "right") - first
        at = np.repeat(np.arange(len(rows)), count)
        within = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        found[at, owners[np.repeat(first, count) + within]] = True
    return found


# --- Spark ----------------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part, whatever their size."""
    vector = F.col("vector")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    ).filter(F.col("id").isNotNull() & finite & F.exists(vector, lambda x: x != 0))


def nearest(
    vectors: DataFrame,
    query_filter: str,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    target_recall: float = 0.95,
    sample: int = 1_000,
    query_block: int = 1_024,
    seed: int = 1,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``neighbour_id`` and ``distance`` of the ``k``
    nearest rows found for each usable row whose ``id`` meets ``query_filter`` (all
    rows of its size, if there are fewer).

    ``sample`` bounds the rows that the index is fitted on, ``query_block`` what is sent
    to every task: about that many vectors, for each of which a task makes bucket keys of
    twelve bytes, one for each table and probe.
    """
    spark = vectors.sparkSession
    # Stored, so that a row keeps its number.
    rows = staged(
        usable(vectors, id_column, vector_column).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "neighbours-rows",
    )
    counts = rows.groupBy(F.size("vector").alias("size")).count().collect()  # a row a size
    found = spark.createDataFrame([], "query long, query_id long, id long, distance double")
    for size, there in sorted(counts):
        of_size = rows.filter(F.size("vector") == size)
        drawn = of_size.orderBy(F.xxhash64("id"), "id", "row").limit(sample).collect()  # bounded
        points = np.array([r.vector for r in drawn])
        # Among the rows of a sample fewer are as near as the k nearest of all.
        wanted = -(-k * len(points) // there)
        chosen = fit(points, wanted, target_recall, seed)
        asked = of_size.filter(query_filter)
        part = _nearest_of(of_size, asked, there, chosen.hashing, chosen.probes, k, query_block)
        if part is not None:
            names = asked.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
            found = found.unionByName(part.join(names, "query"))
    return _ranked(found, k)


def _nearest_of(
    rows: DataFrame, asked: DataFrame, there: int, hashing: Tables, probes: int, k: int, block: int
) -> DataFrame | None:
    """The ``k`` best rows of each query among ``there`` rows of one size."""
    found = _search(rows, asked, hashing, probes, k, block)
    if found is None:
        return None
    counts = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    lacking = (  # each query can find all rows but its own
        asked.join(counts, F.col("row") == F.col("query"), "left")
        .filter(F.coalesce("n", F.lit(0)) < min(k, there - 1))
        .select("row")
    )
    missed = asked.join(lacking, "row", "left_semi")
    whole = _search(rows, missed, None, probes, k, block)
    if whole is not None:
        lacking = lacking.withColumnRenamed("row", "query")
        found = found.join(lacking, "query", "left_anti").unionAll(whole)
    return found


class _Asked:
    """A block of queries. Their bucket keys are made where they are first needed, once
    for all tasks that one Python worker runs on the block."""

    def __init__(self, rows: np.ndarray, points: np.ndarray, hashing: Tables | None, probes: int):
        self.rows, self.points, self.hashing, self.probes = rows, points, hashing, probes

    @functools.cached_property
    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        return self.hashing.probes(self.points, self.probes)


def _search(
    rows: DataFrame, asked: DataFrame, hashing: Tables | None, probes: int, k: int, block: int
) -> DataFrame | None:
    """The ``k`` best of each query, searched and stored block by block; without
    hashing, of all rows. None if nothing is asked."""
    spark = rows.sparkSession
    asked = staged(asked, "neighbours-asked")
    n = asked.count()
    blocks = -(-n // block)
    schema = "query long, id long, distance double"
    path = workspace(spark, "neighbours-found")
    parts = []
    for number in range(blocks):
        of_block = F.pmod(F.xxhash64("row"), F.lit(blocks)) == number
        held = asked.filter(of_block).collect()  # about query_block rows
        if not held:
            continue
        numbers = np.array([r.row for r in held], np.int64)
        points = np.array([r.vector for r in held])
        sent = spark.sparkContext.broadcast(_Asked(numbers, points, hashing, probes))
        parts.append(f"{path}/{number}")
        _top(rows.mapInArrow(_searcher(sent, k), schema), k).write.parquet(parts[-1])
        sent.destroy()
    return spark.read.schema(schema).parquet(*parts) if parts else None


def _searcher(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        queries, points = asked.rows, asked.points
        best = Best(len(queries), k)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                own, number = some.column("id").to_numpy(), some.column("row").to_numpy()
                vectors = some.column("vector").flatten().to_numpy().reshape(len(own), -1)
                if asked.hashing is None:
                    wanted = np.ones((len(own), len(queries)), bool)
                else:
                    wanted = _candidates(asked.hashing, *asked.keys, vectors, len(queries))
                wanted &= number[:, None] != queries[None, :]
                row, query = np.nonzero(wanted)
                for i in range(0, len(row), _PAIRS):
                    r, q = row[i : i + _PAIRS], query[i : i + _PAIRS]
                    best.offer(q, own[r], distances(vectors[r], points[q]))
        query, row, distance = best.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries[query]), pa.array(row), pa.array(distance)],
            names=["query", "id", "distance"],
        )

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    nearest_first = Window.partitionBy("query").orderBy("distance", "id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first))
    return ranked.filter(F.col("rank") <= k).drop("rank")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest_first = Window.partitionBy("query").orderBy("distance", "id")
    return found.select(
        "query_id",
        F.row_number().over(nearest_first).alias("rank"),
        F.col("id").alias("neighbour_id"),
        "distance",
    )
