"""The curated copy, kept up to date with what lands."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from wellgauge.config import JobConfig
from wellgauge.operators.curate import curate
from wellgauge.sources.tables import stream_raw
from wellgauge.streaming.control import AVAILABLE_NOW
from wellgauge.streaming.counts import WRITE, observe_counts


def start_curated(
    spark: SparkSession, config: JobConfig, trigger: Mapping = AVAILABLE_NOW
) -> StreamingQuery:
    """Append newly landed rows to the curated table, each exactly once. They are counted
    on the way if counts are to be reported."""
    curated = curate(stream_raw(spark, config.layout.raw, config.raw_options))
    if config.report is not None:
        curated = observe_counts(curated, WRITE)
    return (
        curated.writeStream.queryName(f"curated to {config.layout.curated}")
        .format("parquet")
        .outputMode("append")
        .option("path", config.layout.curated)
        .option("checkpointLocation", config.curated_checkpoint)
        .trigger(**trigger)
        .start()
    )
