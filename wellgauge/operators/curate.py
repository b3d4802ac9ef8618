"""The curated copy: raw rows with information on their load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def curate(raw: DataFrame) -> DataFrame:
    """Tag each row with the partition that handled it and the load time.

    The partition id tells where a row was processed; it is not stable between
    runs. The load time is one value per batch.
    """
    return raw.withColumn("partition_id", F.spark_partition_id()).withColumn(
        "timestamp", F.current_timestamp()
    )


def preview(table: DataFrame, rows: int = 10) -> DataFrame:
    """Any few rows, for a person to look at."""
    return table.limit(rows)
