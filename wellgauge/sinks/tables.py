"""Parquet writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellgauge.schemas import HOURLY_PARTITIONS, PARTIALS, PARTIALS_PARTITIONS, TOUCHED


def append_table(table: DataFrame, path: str) -> None:
    table.write.mode("append").parquet(path)


def overwrite_table(table: DataFrame, path: str) -> None:
    """Replace a whole table. The path must not be one the table is read from."""
    table.write.mode("overwrite").parquet(path)


def write_hourly(hourly: DataFrame, path: str, whole_table: bool = False) -> None:
    """Replace the hours that the rows belong to and leave all others alone, or
    with ``whole_table`` replace all hours the table has.

    Replacing single hours moves them into place one by one, on the driver; a
    whole table is written in place by the executors.

    The rebalance brings the rows of a metric and hour together, so an hour gets
    one file and not one from each task; adaptive execution splits an hour that
    is too big for a task.
    """
    (
        hourly.hint("rebalance", *HOURLY_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
        .partitionBy(*HOURLY_PARTITIONS)
        .parquet(path)
    )


def write_partials(partials: DataFrame, batches: Column, path: str) -> None:
    """Store sums and counts by date and the range of batches they come from. What is
    there of the same date and batches is replaced, as a whole or not at all."""
    (
        partials.withColumn("batches", batches)
        .select(*PARTIALS.names)
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTIALS_PARTITIONS)
        .parquet(path)
    )


def write_touched(touched: DataFrame, batch_id: int, path: str) -> None:
    """Note the hours that a batch touched; a repeated batch replaces its note."""
    (
        touched.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .select(*TOUCHED.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
