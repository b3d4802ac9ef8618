"""Message rows to envelope rows, and payload text to a number.

No function here drops a row: rows out = messages in, whatever the messages
hold. All work on batch and on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellgauge.functions import calendar_parts, event_time, finite, text
from wellgauge.schemas import ENVELOPE, PAYLOAD


def as_text(messages: DataFrame) -> DataFrame:
    """Key and value of each message as text, nothing decoded."""
    return messages.select(text("key"), text("value"))


def decode_nested(messages: DataFrame) -> DataFrame:
    """Each message value as one struct column, ``value``."""
    return messages.select(decoded("value").alias("value"))


def decoded(name: str) -> Column:
    """The envelope that a column of bytes holds."""
    return F.from_json(text(name), ENVELOPE)


def decode_envelope(messages: DataFrame) -> DataFrame:
    """Each message value as the five envelope columns."""
    return decode_nested(messages).select("value.*")


def payload_value(raw: DataFrame) -> DataFrame:
    """Replace ``payload`` by the number it carries.

    The payload type is a contract, not inferred, so one odd reading cannot
    change the type of all others: what is no finite number becomes NULL.
    """
    # In two steps, so that the payload is parsed once.
    return (
        raw.withColumn("value", _parsed(F.col("payload")))
        .withColumn("value", finite(F.col("value")))
        .drop("payload")
    )


def number_of(payload: Column) -> Column:
    """The finite number that a payload carries, NULL if there is none."""
    return F.transform(F.array(_parsed(payload)), finite)[0]


def _parsed(payload: Column) -> Column:
    return F.from_json(payload, PAYLOAD)["value"]


def event_time_parts(raw: DataFrame) -> DataFrame:
    """Add year, month, day and hour of the event time."""
    return (
        raw.withColumn("event_time", event_time(F.col("@timestamp")))
        .withColumns(calendar_parts(F.col("event_time")))
        .drop("event_time")
    )
