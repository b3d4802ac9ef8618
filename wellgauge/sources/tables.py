"""Readers of the stored tables.

Each names its schema, so opening a table reads no file footers and partition
values keep their declared type.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellgauge.schemas import (
    CHANGES,
    CURATED,
    HOURLY,
    HOURLY_PARTITIONS,
    PARTIALS,
    RAW,
    RAW_NESTED,
    REJECTS,
    TOUCHED,
)

# A file stream ignores files much older than the newest it has seen, a week by
# default. No file may be left out, so the age is set beyond any; the price is that
# the driver remembers the path of every file.
ALL_FILES = {"maxFileAge": "36500d"}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW).parquet(path)


def stream_raw(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The raw table as a stream of what each landing added."""
    return spark.readStream.schema(RAW).options(**{**ALL_FILES, **(options or {})}).parquet(path)


def stream_curated(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The curated table as a stream of what each batch added."""
    return spark.readStream.schema(CURATED).options(**{**ALL_FILES, **(options or {})}).parquet(path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Messages that did not decode, as they came."""
    return spark.read.schema(REJECTS).parquet(path)


def read_backfill(spark: SparkSession, path: str) -> DataFrame:
    """The table of a batch backfill: one struct column, ``value``."""
    return spark.read.schema(RAW_NESTED).parquet(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CURATED).parquet(path)


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """Hourly averages of all metrics; partition columns come last."""
    return spark.read.schema(HOURLY).parquet(path)


def of_metric(hourly: DataFrame, metric: str) -> DataFrame:
    """Stored averages of one metric, columns in relation order. Only the
    folders of that metric are read."""
    return hourly.filter(F.col("name") == metric).select(*HOURLY.names)


def read_partials(
    spark: SparkSession, path: str, dates: Iterable[str | None] | None = None
) -> DataFrame:
    """All stored deltas of all dates, or of some; ``batch_id`` is the last batch of each.

    Given dates are opened by path: listing them does not grow with the history.
    """
    folders = [path] if dates is None else [date_folder(path, d) for d in dates]
    last = F.substring_index("batches", "-", -1).cast("long")
    return read_partials_at(spark, path, folders).withColumn("batch_id", last)


def date_folder(path: str, date: str | None) -> str:
    return f"{path}/event_date={date or '__HIVE_DEFAULT_PARTITION__'}"


def read_partials_at(spark: SparkSession, path: str, folders: Iterable[str]) -> DataFrame:
    """The sums in some folders of the table at ``path``."""
    return spark.read.schema(PARTIALS).option("basePath", path).parquet(*folders)


def read_touched(spark: SparkSession, path: str, folders: Iterable[str]) -> DataFrame:
    """Hours that the batches of some folders touched."""
    return spark.read.schema(TOUCHED).option("basePath", path).parquet(*folders)


def read_changes(spark: SparkSession, files: Iterable[str]) -> DataFrame:
    """Metrics that some files note as changed."""
    return spark.read.schema(CHANGES).parquet(*files)


def ensure_hourly(spark: SparkSession, path: str) -> None:
    """Create the hourly table where it is missing, so that a run without any
    message leaves an empty table and not a missing one."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in HOURLY.fields]
    empty = spark.range(0, 0, 1, 1).select(*columns)
    empty.write.mode("ignore").partitionBy(*HOURLY_PARTITIONS).parquet(path)
