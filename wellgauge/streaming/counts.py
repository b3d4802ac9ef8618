"""Counts of what a stream writes, taken while it writes.

``observe_counts`` adds an observation to a stream: Spark adds the counts up in the tasks
that write, and hands them over with the progress of each batch. A ``CountBook`` takes
them from there and stores them under the number of the batch. Neither stage is read again.

A batch writes without a shuffle, and Spark takes the counts of a task once however
often it was tried, so a lost executor does not count twice. What a run could not store
before it ended is counted from the files of those batches when the next one begins
(``count_uncounted``); which these are the sink's own log tells. Storing a batch again
replaces its counts.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from wellgauge.config import JobConfig
from wellgauge.operators.reports import count_rejected, payload_rejected
from wellgauge.schemas import COUNTS, COUNTS_PARTITIONS, CURATED, RAW
from wellgauge.sinks.folders import file_names, subfolders
from wellgauge.sources.sink_log import latest_batch, read_batches_after
from wellgauge.streaming.control import await_all, start_all

READ, WRITE = "read", "write"

_OBSERVED = "wellgauge {}"
# Partitions that a batch can have. Up to there the histogram is a plain count of each.
_PARTITIONS = 1_000_000
# How long the last progress of an ended query is waited for, in seconds. What comes
# later still is counted from files by the next run.
_PATIENCE = 60


def observe_counts(table: DataFrame, stage: str, names: Iterable[str] = ()) -> DataFrame:
    """The same rows, with counts observed: rows per physical partition, and for a raw
    table messages and payload rejects of each of the names and of all others."""
    columns = table.columns
    place = _free(columns, "partition")
    rejected, names = _free(columns, "rejected"), list(names)
    with_place = table.withColumn(place, F.spark_partition_id())
    counts: list[Column] = [F.expr(f"histogram_numeric({place}, {_PARTITIONS})").alias("partitions")]
    if names:
        with_place = with_place.withColumn(rejected, payload_rejected(F.col("payload")))
        of_name = [F.col("name").eqNullSafe(n) for n in names]
        other = ~F.coalesce(F.col("name").isin(names), F.lit(False))
        for i, here in enumerate([*of_name, other]):
            counts += [
                F.count_if(here).alias(f"messages_{i}"),
                F.count_if(here & F.col(rejected)).alias(f"rejected_{i}"),
            ]
    return with_place.observe(_OBSERVED.format(stage), *counts).select(*_quoted(columns))


def _free(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name


def _quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


class CountBook(StreamingQueryListener):
    """Takes the counts of one stage from the progress of its queries, and stores them.

    Used around the queries: ``with CountBook(...) as book``. ``store`` writes what has
    come in; it is called while queries run, so no more than that is held.
    """

    def __init__(self, spark: SparkSession, config: JobConfig, stage: str):
        self._spark, self._config, self._stage = spark, config, stage
        self._names = list(config.metrics) if stage == READ else []
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def __enter__(self) -> CountBook:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        try:
            self.store()
        finally:
            self._spark.streams.removeListener(self)

    def wait_for(self, query: StreamingQuery) -> None:
        """Until the progress of an ended query has come in."""
        with self._change:
            self._change.wait_for(lambda: query.runId in self._ended, _PATIENCE)

    def store(self) -> None:
        with self._change:
            rows, self._rows = self._rows, []
        if rows:
            store_counts(self._spark.createDataFrame(rows, COUNTS), self._config)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(_OBSERVED.format(self._stage))
        # A batch that the sink had already is not written again, and not counted.
        if seen is None or not seen["partitions"]:
            return
        rows = self._rows_of(seen.asDict(), int(progress.batchId), progress.timestamp)
        with self._change:
            self._rows += rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def _rows_of(self, seen: Mapping, batch_id: int, moment: str) -> list[tuple]:
        end = (moment, self._stage, batch_id)
        rows = [(int(b["x"]), None, int(b["y"]), None, *end) for b in seen["partitions"]]
        for i, name in enumerate([*self._names, None] if self._names else []):
            if seen[f"messages_{i}"]:
                rows.append((None, name, seen[f"messages_{i}"], seen[f"rejected_{i}"], *end))
        return rows


def store_counts(counts: DataFrame, config: JobConfig) -> None:
    """Store the counts of some batches, in place of what they had."""
    (
        counts.select(*COUNTS.names)
        .hint("rebalance", *COUNTS_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*COUNTS_PARTITIONS)
        .parquet(config.counts_path)
    )


def stored_batches(spark: SparkSession, config: JobConfig, stage: str) -> list[int]:
    """Batches of a stage that have counts and wait to be reported, in order."""
    names = subfolders(spark, f"{config.counts_path}/stage={stage}")
    return sorted(int(n.removeprefix("batch_id=")) for n in names)


def reported_upto(spark: SparkSession, config: JobConfig, stage: str) -> int:
    """The last batch of a stage that was reported; -1 for none."""
    names = file_names(spark, f"{config.reported_path}/{stage}")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def count_uncounted(spark: SparkSession, config: JobConfig, stage: str) -> None:
    """Count the batches that a stage wrote and that have no counts, from their files.

    These are the last batches of a run that broke off, or all if counting is new; they
    are stored together, under the number of the last. Files name the partition that
    wrote them.
    """
    path, schema = _table_of(config, stage)
    last = latest_batch(spark, path)
    counted = max([reported_upto(spark, config, stage), *stored_batches(spark, config, stage)])
    if last <= counted:
        return
    rows = read_batches_after(spark, path, schema, counted)
    store_counts(_counts_of(rows, config, stage, last), config)


def _table_of(config: JobConfig, stage: str) -> tuple[str, StructType]:
    if stage == READ:
        return config.layout.raw, RAW
    return config.layout.curated, CURATED


def _counts_of(rows: DataFrame, config: JobConfig, stage: str, batch_id: int) -> DataFrame:
    place = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    counted = F.count(F.lit(1)).alias("messages")
    nothing = F.lit(None)
    counts = (
        rows.groupBy(place.alias("partition_id"))
        .agg(counted)
        .select("partition_id", nothing.cast("string").alias("name"), "messages",
                nothing.cast("long").alias("rejected"))
    )
    if stage == READ:
        known = F.when(F.col("name").isin(list(config.metrics)), F.col("name"))
        marked = rows.select(
            known.alias("name"), payload_rejected(F.col("payload")).alias("is_rejected")
        )
        names = count_rejected(marked).withColumn("partition_id", nothing.cast("int"))
        counts = counts.unionByName(names)
    return counts.withColumns(
        {
            "counted_at": F.current_timestamp().cast("string"),
            "stage": F.lit(stage),
            "batch_id": F.lit(batch_id).cast("long"),
        }
    )


def counting(
    spark: SparkSession, config: JobConfig, stage: str, start: Callable[[], StreamingQuery],
    *others: Callable[[], StreamingQuery],
) -> list[StreamingQuery]:
    """Run a counted query, with others beside it, to its end. Counts that an earlier run
    left out are made up for first."""
    count_uncounted(spark, config, stage)
    with CountBook(spark, config, stage) as book:
        queries = start_all(start, *others)
        try:
            await_all(*queries, meanwhile=book.store)
        finally:
            book.wait_for(queries[0])
    return queries
