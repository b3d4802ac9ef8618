"""Column expressions. All of them stay inside Spark's generated code."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(name: str) -> Column:
    """Bytes of a message as text, under the same name."""
    return F.col(name).cast("string").alias(name)


def finite(value: Column) -> Column:
    """The number, or NULL where it is NaN or infinite.

    Spark orders NaN above every number, so one comparison covers both.
    """
    return F.when(F.abs(value) <= F.lit(sys.float_info.max), value)


def event_time(stamp: Column) -> Column:
    """Event time text as TIMESTAMP, NULL where it is no date and time.

    A bare time of day would be read as a time of *today*, which changes from
    run to run; the text has to hold a date too.
    """
    return F.when(stamp.try_cast("date").isNotNull(), stamp.try_cast("timestamp"))


def calendar_parts(moment: Column) -> dict[str, Column]:
    """Year, month, day and hour, all of the same moment."""
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
        "hour": F.hour(moment),
    }
