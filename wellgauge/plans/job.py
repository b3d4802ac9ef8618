"""The two-step job: land what is new, then enrich it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wellgauge.config import JobConfig
from wellgauge.operators.decode import decode_envelope
from wellgauge.plans.lease import Lease
from wellgauge.session import job_session
from wellgauge.sinks.database import write_metrics
from wellgauge.sinks.folders import data_files, delete
from wellgauge.sources.messages import stream_messages
from wellgauge.sources.tables import read_changes, read_hourly
from wellgauge.streaming.audit import start_offset_audit, start_rejects
from wellgauge.streaming.control import await_all, start_all
from wellgauge.streaming.counts import READ, WRITE, counting, observe_counts
from wellgauge.streaming.curated import start_curated
from wellgauge.streaming.hourly import start_hourly, write_pending_hours
from wellgauge.streaming.landing import start_landing
from wellgauge.streaming.reporting import report_stage


def land(spark: SparkSession, config: JobConfig, messages: DataFrame | None = None) -> None:
    """Step 1: append the messages that arrived since the last run to raw. Beside it,
    keep what does not decode and note offsets that are gone, as configured."""
    job_session(spark)
    if messages is None:
        if config.source is None:
            raise ValueError("landing needs a message source")
        messages = stream_messages(spark, config.source)
    layout = config.layout
    starts = [
        lambda: start_landing(
            messages, layout.raw, config.landing_checkpoint, decode=_decoding(config)
        )
    ]
    if config.keep_rejects and layout.rejects:
        starts.append(lambda: start_rejects(messages, layout.rejects, config.rejects_checkpoint))
    if config.check_offsets:
        starts.append(lambda: start_offset_audit(messages, config))
    _run(spark, config, READ, *starts)


def _decoding(config: JobConfig) -> Callable[[DataFrame], DataFrame]:
    """Decoding, with counts taken on the way if they are to be reported."""
    if config.report is None:
        return decode_envelope
    return lambda messages: observe_counts(decode_envelope(messages), READ, config.metrics)


def _run(
    spark: SparkSession, config: JobConfig, stage: str, *starts: Callable[[], StreamingQuery]
) -> list[StreamingQuery]:
    """Start the queries, the first of them that of a stage, and wait for their end."""
    if config.report is not None:
        return counting(spark, config, stage, *starts)
    queries = start_all(*starts)
    await_all(*queries)
    return queries


def enrich(spark: SparkSession, config: JobConfig) -> None:
    """Step 2: bring the curated copy and the hourly averages up to date.

    Both follow the raw table by themselves and run side by side. An hour is written
    once, however many batches of the run touched it.
    """
    job_session(spark)
    _, hourly = _run(
        spark,
        config,
        WRITE,
        lambda: start_curated(spark, config),
        lambda: start_hourly(spark, config, hours_each_batch=False),
    )
    write_pending_hours(spark, config, hourly)


def publish(spark: SparkSession, config: JobConfig) -> None:
    """Send the metrics whose averages changed since the last call to the database,
    if there is one. A call that fails leaves them to the next."""
    job_session(spark)
    if config.jdbc is None:
        return
    # What is noted from now on is left to the next call.
    noted = data_files(spark, config.changes_path)
    if not noted:
        return
    changes = read_changes(spark, noted)
    names = {r.name for r in changes.distinct().collect()}  # the metrics, at most
    changed = [metric for metric in config.metrics if metric in names]
    write_metrics(read_hourly(spark, config.layout.hourly), config.jdbc, changed)
    delete(spark, noted)


def publish_all(spark: SparkSession, config: JobConfig) -> None:
    """Send all stored averages to the database, changed or not."""
    job_session(spark)
    if config.jdbc is not None:
        write_metrics(read_hourly(spark, config.layout.hourly), config.jdbc, config.metrics)


def report(spark: SparkSession, config: JobConfig) -> None:
    """Write row counts of both stages and payload rejects of what is new, if asked
    for. They were counted while the stages wrote; neither table is read."""
    job_session(spark)
    if config.report is not None:
        for stage in (READ, WRITE):
            report_stage(spark, config, stage)


def run_job(spark: SparkSession, config: JobConfig, messages: DataFrame | None = None) -> None:
    """Both steps in order; a failed one ends the job. Only one run works on the tables:
    while another does, ``LeaseHeld`` is raised."""
    with Lease(spark, config.lease_path, config.lease_seconds) as lease:
        land(spark, config, messages)
        for step in (enrich, publish, report):
            lease.check()
            step(spark, config)
