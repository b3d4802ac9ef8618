"""Any table as message-log rows, to replay it through the job.

Works on batch and on streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellgauge.schemas import MESSAGE_LOG

STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def as_messages(
    table: DataFrame, key: Column, value: Column, offset: Column, moment: Column
) -> DataFrame:
    """Key and value texts with the coordinates a message log adds."""
    columns = [
        key.cast("string").cast("binary"),
        value.cast("string").cast("binary"),
        F.lit("replay"),
        F.lit(0),
        offset,
        moment.cast("timestamp"),
        F.lit(0),
    ]
    return table.select(
        *[
            c.cast(f.dataType).alias(f.name)
            for c, f in zip(columns, MESSAGE_LOG.fields, strict=True)
        ]
    )


def events_as_messages(events: DataFrame, payload: Column | None = None) -> DataFrame:
    """Rows of the ``events`` table as the JSON messages a sensor would send."""
    if payload is None:
        payload = F.to_json(F.struct("value"))
    envelope = F.to_json(
        F.struct(
            F.lit("replay").alias("@metadata"),
            F.date_format("ts", STAMP_FORMAT).alias("@timestamp"),
            F.col("event_type").alias("name"),
            payload.alias("payload"),
            F.col("user_id").cast("string").alias("well_id"),
        )
    )
    return as_messages(events, F.col("user_id"), envelope, F.col("event_id"), F.col("ts"))
