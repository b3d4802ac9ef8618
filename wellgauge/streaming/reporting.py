"""Count reports: each batch of a stage once.

Reports are made from the counts that stages store while they write (``counts``), so they
read neither table. All reports of a stage's batches are written before the batches count
as reported; when one of the writes fails, the next call writes all of them again, each
batch in place of what it had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellgauge.config import JobConfig
from wellgauge.schemas import COUNTS
from wellgauge.sinks.folders import delete, file_names, touch
from wellgauge.sinks.report import write_report
from wellgauge.streaming.counts import (
    READ,
    WRITE,
    count_uncounted,
    reported_upto,
    stored_batches,
)

# The names that the reports have in the sink.
READ_REPORT = "spark-read"
WRITE_REPORT = "spark-write"
REJECT_REPORT = "spark-rejects"


def report_stage(spark: SparkSession, config: JobConfig, stage: str) -> None:
    """Send the counts of the batches that were not reported yet to the report sink."""
    count_uncounted(spark, config, stage)
    waiting = stored_batches(spark, config, stage)
    done = reported_upto(spark, config, stage)
    new = [b for b in waiting if b > done]
    if new:
        counts = read_counts(spark, config, stage, new)
        for name, rows in _reports_of(counts, stage).items():
            write_report(rows, config.report, name)
        touch(spark, f"{config.reported_path}/{stage}/{new[-1]}")
    # From here on the batches are done, whatever happens to what is left of them.
    folder = f"{config.reported_path}/{stage}"
    last = max([done, *new])
    numbers = [n for n in file_names(spark, folder) if n.isdigit() and int(n) < last]
    delete(spark, [f"{folder}/{n}" for n in numbers])
    delete(spark, [_folder(config, stage, b) for b in waiting])


def read_counts(spark: SparkSession, config: JobConfig, stage: str, batches: list[int]) -> DataFrame:
    """The stored counts of some batches, opened by path."""
    folders = [_folder(config, stage, b) for b in batches]
    return spark.read.schema(COUNTS).option("basePath", config.counts_path).parquet(*folders)


def _folder(config: JobConfig, stage: str, batch_id: int) -> str:
    return f"{config.counts_path}/stage={stage}/batch_id={batch_id}"


def _reports_of(counts: DataFrame, stage: str) -> dict[str, DataFrame]:
    places = counts.filter("partition_id is not null").select(
        "partition_id",
        F.col("messages").alias("count"),
        F.col("counted_at").alias("@timestamp"),
        "stage",
        _report_id("partition_id"),
        "batch_id",
    )
    if stage == WRITE:
        return {WRITE_REPORT: places}
    names = counts.filter("partition_id is null").select(
        "name", "messages", "rejected", _report_id("name"), "batch_id"
    )
    return {READ_REPORT: places, REJECT_REPORT: names}


def _report_id(key: str):
    """The same for the same row of the same batch, however often it is sent."""
    part = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.concat_ws("-", "stage", F.col("batch_id").cast("string"), part).alias("report_id")


__all__ = ["READ", "READ_REPORT", "REJECT_REPORT", "WRITE", "WRITE_REPORT", "report_stage"]
