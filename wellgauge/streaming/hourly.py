"""Hourly averages, kept up to date with what lands.

Raw rows are read once, in the batch that brings them. A batch is reduced to sums and
counts per well, metric and hour, which are stored as a delta of each date (see
``deltas``). The hours that batches touched are noted and replaced in the hourly table
later: after each batch, or once for all batches of a run. Late readings therefore never
get lost, and history is neither read nor written again for them.

Every step can be repeated after a failure. A batch replaces its own deltas; notes of
touched hours are taken back only when these are written.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wellgauge.config import JobConfig
from wellgauge.operators.averages import (
    hour_readings,
    hourly_partials,
    merge_partials,
)
from wellgauge.operators.decode import payload_value
from wellgauge.sinks.folders import delete, subfolders
from wellgauge.sinks.tables import append_table, write_hourly, write_touched
from wellgauge.sources.tables import ensure_hourly, read_touched, stream_raw
from wellgauge.streaming.control import AVAILABLE_NOW
from wellgauge.streaming.deltas import merge_deltas, stored_sums, write_delta

# Touched dates that are merged and written together. It bounds how many paths one
# read is given; all touched dates have their turn.
DATES_AT_A_TIME = 366


def start_hourly(
    spark: SparkSession,
    config: JobConfig,
    trigger: Mapping = AVAILABLE_NOW,
    hours_each_batch: bool = True,
) -> StreamingQuery:
    """Follow the raw table. Unless ``hours_each_batch``, the caller brings the hourly
    table up to date by ``write_pending_hours`` once the query has ended."""
    ensure_hourly(spark, config.layout.hourly)
    # Filter and projection belong to the streaming plan: a batch is opaque to
    # the optimizer, so inside it nothing would be pushed down to the files.
    raw = stream_raw(spark, config.layout.raw, config.raw_options)
    readings = hour_readings(payload_value(raw), config.metrics)

    def take(batch: DataFrame, batch_id: int) -> None:
        # Batch numbers belong to a checkpoint, and so do the sums stored under them:
        # the id of the query lives in the checkpoint and goes with it.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        add_batch(batch, batch_id, _sums_path(config, query_id))
        if hours_each_batch:
            _write_pending(batch.sparkSession, config, query_id)

    return (
        readings.writeStream.queryName(f"hourly to {config.layout.hourly}")
        .foreachBatch(take)
        .option("checkpointLocation", config.hourly_checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_pending_hours(spark: SparkSession, config: JobConfig, query: StreamingQuery) -> None:
    """Replace, once, the hours that the batches of ``query`` have touched since hours
    were last written, by earlier runs that failed as well."""
    _write_pending(spark, config, query.id)


def _write_pending(spark: SparkSession, config: JobConfig, query_id: str) -> None:
    sums_path = _sums_path(config, query_id)
    write_touched_hours(spark, sums_path, config.layout.hourly, config.changes_path)


def _sums_path(config: JobConfig, query_id: str) -> str:
    return f"{config.partials_path}/query-{query_id}"


def _touched_path(sums_path: str) -> str:
    return f"{sums_path}-touched"


def refresh_hours(readings: DataFrame, batch_id: int, partials_path: str, hourly_path: str) -> None:
    """Bring the hourly table up to date with one batch of readings."""
    add_batch(readings, batch_id, partials_path)
    write_touched_hours(readings.sparkSession, partials_path, hourly_path)


def add_batch(readings: DataFrame, batch_id: int, sums_path: str) -> None:
    """Add one batch of readings to the stored sums, and note the hours it touched."""
    spark = readings.sparkSession
    # One row per group: used several times below, computed from raw once.
    # A lost executor costs a recomputation of its part, not the batch.
    partials = (
        hourly_partials(readings)
        .withColumn("event_date", F.col("event_hour").cast("date").cast("string"))
        .persist()
    )
    try:
        write_delta(partials, batch_id, sums_path)
        for dates in _dates_in_chunks(partials):
            merge_deltas(spark, sums_path, dates, batch_id)
        touched = partials.select("event_date", "name", "event_hour").distinct()
        write_touched(touched, batch_id, _touched_path(sums_path))
    finally:
        partials.unpersist()


def write_touched_hours(
    spark: SparkSession, sums_path: str, hourly_path: str, changes_path: str | None = None
) -> None:
    """Replace the hours that are noted as touched. The metrics they belong to are
    noted under ``changes_path``, for those who follow the hourly table."""
    notes = [f"{_touched_path(sums_path)}/{n}" for n in subfolders(spark, _touched_path(sums_path))]
    if not notes:
        return
    touched = read_touched(spark, _touched_path(sums_path), notes)
    for dates in _dates_in_chunks(touched):
        hours = touched.filter(_on_dates(dates)).select("name", "event_hour").distinct()
        stored = _in_hours(stored_sums(spark, sums_path, dates), hours)
        write_hourly(merge_partials(stored), hourly_path)
    if changes_path is not None:
        append_table(touched.select("name").distinct().coalesce(1), changes_path)
    delete(spark, notes)


def _dates_in_chunks(table: DataFrame) -> Iterator[list[str | None]]:
    """The dates of a table. They come to the driver chunk by chunk, however many."""
    dates = (r.event_date for r in table.select("event_date").distinct().toLocalIterator())
    while chunk := list(islice(dates, DATES_AT_A_TIME)):
        yield chunk


def _on_dates(dates: list[str | None]) -> Column:
    """Rows of the dates; readings without a usable time have none."""
    return F.coalesce("event_date", F.lit("")).isin([d or "" for d in dates])


def _in_hours(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """Stored rows of the touched hours, the NULL hour included."""
    stored, touched = stored.alias("stored"), touched.alias("touched")
    same_name = F.col("stored.name") == F.col("touched.name")
    same_hour = F.col("stored.event_hour").eqNullSafe(F.col("touched.event_hour"))
    return stored.join(touched, same_name & same_hour, "left_semi")
