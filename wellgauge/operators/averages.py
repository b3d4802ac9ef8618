"""Hourly averages per well and metric.

One aggregation serves all metrics. Spark aggregates before the shuffle, so a
well, metric or hour that holds a large part of all rows sends one row per map
task, not its readings.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellgauge.functions import calendar_parts, event_time
from wellgauge.schemas import HOURLY

GROUP = ["well_id", "name", "event_hour"]


def hour_readings(decoded: DataFrame, metrics: str | Iterable[str]) -> DataFrame:
    """Readings of the metrics with the hour they belong to.

    Readings without a usable event time keep a NULL hour.
    """
    names = [metrics] if isinstance(metrics, str) else list(metrics)
    return decoded.filter(F.col("name").isin(names)).select(
        "well_id",
        "name",
        F.date_trunc("hour", event_time(F.col("@timestamp"))).alias("event_hour"),
        "value",
    )


def hourly_avg(decoded: DataFrame, metrics: str | Iterable[str]) -> DataFrame:
    """Averages over a whole decoded table, for one metric or several."""
    averages = (
        hour_readings(decoded, metrics)
        .groupBy(*GROUP)
        .agg(F.avg("value").alias("hourly_avg_value"))
    )
    return _as_hourly(averages)


def hourly_partials(readings: DataFrame) -> DataFrame:
    """Sum and count per group: averages in a form that can still be merged."""
    return readings.groupBy(*GROUP).agg(
        F.sum("value").alias("value_sum"), F.count("value").alias("value_count")
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Averages from any number of partial rows per group."""
    return averages_of(sum_partials(partials))


def sum_partials(partials: DataFrame, *further: str) -> DataFrame:
    """One row per group, from any number of partial rows; ``further`` columns are
    the same in all rows of a group and stay."""
    return partials.groupBy(*GROUP, *further).agg(
        F.sum("value_sum").alias("value_sum"), F.sum("value_count").alias("value_count")
    )


def averages_of(sums: DataFrame) -> DataFrame:
    """Averages from sums and counts that are one row per group."""
    average = F.try_divide("value_sum", "value_count").alias("hourly_avg_value")
    return _as_hourly(sums.select(*GROUP, average))


def _as_hourly(grouped: DataFrame) -> DataFrame:
    return grouped.withColumns(calendar_parts(F.col("event_hour"))).select(*HOURLY.names)
