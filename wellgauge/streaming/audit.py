"""Streams beside the landing that keep what it loses: content that does not decode,
and the knowledge of offsets that were gone.

Both read the log by checkpoints of their own, so landing does not wait for them and
each message is judged once, whatever fails.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wellgauge.config import JobConfig
from wellgauge.operators.offsets import ENDS, GAPS, gaps_between, island_ends, offset_islands
from wellgauge.operators.rejects import undecoded
from wellgauge.sinks.folders import delete, exists, subfolders
from wellgauge.streaming.control import AVAILABLE_NOW


def start_rejects(
    messages: DataFrame, path: str, checkpoint: str, trigger: Mapping = AVAILABLE_NOW
) -> StreamingQuery:
    """Append the messages that do not decode to a table of their own, each once."""
    return (
        undecoded(messages)
        .writeStream.queryName(f"rejects to {path}")
        .format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_offset_audit(
    messages: DataFrame, config: JobConfig, trigger: Mapping = AVAILABLE_NOW
) -> StreamingQuery:
    """Note the ranges of offsets that the log no longer had. The last offset of each
    topic partition is kept, so what expired between two runs is found as well."""

    def take(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        audit_batch(batch, batch_id, f"{config.offsets_path}/query-{query_id}", config.gaps_path)

    coordinates = messages.select("topic", "partition", "offset")
    return (
        coordinates.writeStream.queryName(f"offsets of {config.layout.raw}")
        .foreachBatch(take)
        .option("checkpointLocation", config.offsets_checkpoint)
        .trigger(**trigger)
        .start()
    )


def audit_batch(messages: DataFrame, batch_id: int, ends_path: str, gaps_path: str) -> None:
    """Add one batch. A repeated batch starts from the ends of the batch before it and
    replaces what it wrote."""
    spark = messages.sparkSession
    islands = offset_islands(messages).persist()  # a row per island; used twice
    try:
        versions = sorted(int(n.removeprefix("batch_id=")) for n in subfolders(spark, ends_path))
        earlier = [v for v in versions if v < batch_id]
        known = spark.createDataFrame([], ENDS)
        if earlier:
            known = spark.read.schema(ENDS).parquet(f"{ends_path}/batch_id={earlier[-1]}")
        log = F.lit(ends_path.rpartition("/")[2]).alias("log")
        numbered = F.lit(batch_id).cast("long").alias("batch_id")
        (
            gaps_between(islands, known)
            .select("*", log, numbered)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("log", "batch_id")
            .parquet(gaps_path)
        )
        ends = island_ends(islands.select("topic", "partition", "last").unionByName(known))
        ends.write.mode("overwrite").parquet(f"{ends_path}/batch_id={batch_id}")
        # A repeated batch needs the ends before it, and none before those.
        delete(spark, [f"{ends_path}/batch_id={v}" for v in earlier[:-1]])
    finally:
        islands.unpersist()


def read_gaps(spark: SparkSession, config: JobConfig) -> DataFrame:
    """All ranges of offsets that were found missing."""
    if not exists(spark, config.gaps_path):
        return spark.createDataFrame([], GAPS)
    found = spark.read.schema(f"{GAPS}, log STRING, batch_id LONG").parquet(config.gaps_path)
    return found.drop("log", "batch_id")
