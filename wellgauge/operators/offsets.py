"""Offsets that a message log no longer had when it was read.

A log numbers the messages of each topic partition without gaps. Where numbers are
missing, messages expired before they were read (or the log was compacted). Islands of
consecutive offsets are found inside each task, so what is shuffled is a row per island
and not per message; gaps are what lies between islands.

Islands are ordered within blocks of ``BLOCK`` offsets and blocks among themselves, so a
topic partition that holds most of the log is the work of many tasks. Rows without topic
partition or offset belong to no island. Repeated messages change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1_000_000
ISLANDS = "topic STRING, partition INT, first LONG, last LONG"
ENDS = "topic STRING, partition INT, last LONG"
GAPS = "topic STRING, partition INT, gap_start LONG, gap_end LONG, missing LONG"

_KEY = ["topic", "partition"]


def offset_islands(messages: DataFrame) -> DataFrame:
    """Stretches of consecutive offsets, as far as each task sees them: several may
    touch or overlap."""
    rows = messages.select(
        F.col("topic").cast("string"), F.col("partition").cast("int"), F.col("offset").cast("long")
    )
    return rows.filter("partition is not null and offset is not null").mapInArrow(_islands, ISLANDS)


def _islands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        topics = pc.dictionary_encode(batch.column(0), null_encoding="encode")
        topic = topics.indices.to_numpy()
        partition, offset = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        order = np.lexsort((offset, partition, topic))
        topic, partition, offset = topic[order], partition[order], offset[order]
        new = np.ones(len(order), bool)
        new[1:] = (
            (topic[1:] != topic[:-1])
            | (partition[1:] != partition[:-1])
            | (offset[1:] - offset[:-1] > 1)
        )
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(order)) - 1
        yield pa.RecordBatch.from_arrays(
            [
                topics.dictionary.take(pa.array(topic[starts])),
                pa.array(partition[starts]),
                pa.array(offset[starts]),
                pa.array(offset[ends]),
            ],
            names=["topic", "partition", "first", "last"],
        )


def island_ends(islands: DataFrame) -> DataFrame:
    """The last offset of each topic partition."""
    return islands.groupBy(*_KEY).agg(F.max("last").alias("last"))


def gaps_between(islands: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Ranges of offsets that lie between islands, both ends included. ``known`` has the
    last offsets that earlier runs have seen; what is missing after them counts too."""
    if known is not None:
        before = known.select(*_KEY, F.col("last").alias("first"), "last")
        islands = islands.unionByName(before)
    placed = islands.withColumn("block", F.floor(F.col("first") / BLOCK))
    within = Window.partitionBy(*_KEY, "block").orderBy("first", "last")
    earlier = Window.partitionBy(*_KEY).orderBy("block")
    unto = (Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy(*_KEY, "block")
        .agg(F.max("last").alias("block_last"))
        .select(*_KEY, "block", F.max("block_last").over(earlier.rowsBetween(*unto)).alias("reached"))
        .withColumnsRenamed({"topic": "t", "partition": "p", "block": "b"})
    )
    same = F.col("topic").eqNullSafe(F.col("t")) & (F.col("partition") == F.col("p"))
    seen = placed.withColumn("seen", F.max("last").over(within.rowsBetween(*unto)))
    # The furthest offset reached before an island begins.
    reached = F.greatest("seen", "reached")
    return (
        seen.join(blocks, same & (F.col("block") == F.col("b")))
        .filter(F.col("first") > reached + 1)
        .select(
            *_KEY,
            (reached + 1).alias("gap_start"),
            (F.col("first") - 1).alias("gap_end"),
            (F.col("first") - reached - 1).alias("missing"),
        )
    )


def offset_gaps(messages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Ranges of offsets that a batch of messages lacks, see ``gaps_between``."""
    return gaps_between(offset_islands(messages), known)
