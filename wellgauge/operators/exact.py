"""Hourly averages that do not depend on the order of summation.

A sum of doubles depends on the order in which they are added, and with it on files,
partitions and batches. Here a reading is taken apart into whole numbers: it is cut at
fixed places, 32 bits apart, into at most three parts, each an exact multiple of its place.
Parts of one place are added as integers, so their sums are the same in any order, and they
can be stored and merged like other partial sums. The average is the exact sum over the
count, rounded once.

A group has a row for each place its readings reach, two or three where they are of one
size, and one for their count. A place sums up to two thousand million readings of a group
without overflow; beyond, the sum is an error and not a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wellgauge.functions import calendar_parts
from wellgauge.operators.averages import GROUP, hour_readings
from wellgauge.schemas import HOURLY

_BITS = 32
_PARTS = 3  # 53 bits, wherever they begin, reach over three places at most
# The place that holds the count of a group's readings.
COUNT = -1000


def exact_partials(readings: DataFrame) -> DataFrame:
    """``place`` and ``total`` per group: what averages are made of, in a form that can be
    merged. Groups whose readings are all NULL have a count of 0."""
    value = F.col("value")
    parts = F.concat(
        F.array(F.struct(F.lit(COUNT).alias("place"), value.isNotNull().cast("long").alias("total"))),
        F.when(value.isNull() | (value == 0), F.array().cast("array<struct<place:int,total:bigint>>"))
        .otherwise(_parts_of(value)),
    )
    cut = readings.select(*GROUP, F.explode(parts).alias("part")).select(*GROUP, "part.*")
    return merge_exact(cut.filter((F.col("total") != 0) | (F.col("place") == COUNT)))


def _parts_of(value: Column) -> Column:
    """Whole multiples of 2**(32 * place) that add up to the value, the largest first."""
    exponent = F.floor(F.log2(F.abs(value)) / _BITS).cast("int")
    # The logarithm may be rounded up over a border: one place more does no harm.
    first = exponent + 1

    def scaled(number: Column, place: Column) -> Column:
        """The number times 2**(32 * place), in two steps of half the power: powers of two
        change no digit, but the whole power may be beyond what a double holds."""
        half = F.pow(F.lit(2.0), (place * (_BITS // 2)).cast("double"))
        return number * half * half

    start = F.struct(
        value.alias("rest"),
        F.array().cast("array<struct<place:int,total:bigint>>").alias("parts"),
    )

    def cut(state: Column, step: Column) -> Column:
        place = (first - step).cast("int")
        whole = scaled(state["rest"], -place).cast("long")  # towards zero
        rest = state["rest"] - scaled(whole.cast("double"), place)
        part = F.struct(place.alias("place"), whole.alias("total"))
        return F.struct(rest.alias("rest"), F.concat(state["parts"], F.array(part)).alias("parts"))

    steps = F.array(*[F.lit(i) for i in range(_PARTS + 1)])
    return F.aggregate(steps, start, cut, lambda state: state["parts"])


def merge_exact(partials: DataFrame) -> DataFrame:
    """One row per group and place, from any number of partial rows."""
    return partials.groupBy(*GROUP, "place").agg(F.sum("total").alias("total"))


def exact_averages(partials: DataFrame) -> DataFrame:
    """Averages from any number of partial rows, in the columns of the hourly table."""
    places = F.filter("parts", lambda p: p["place"] != COUNT)
    counts = F.filter("parts", lambda p: p["place"] == COUNT)
    count = F.aggregate(counts, F.lit(0).cast("long"), lambda n, p: n + p["total"])
    grouped = (
        partials.groupBy(*GROUP)
        .agg(F.collect_list(F.struct("place", "total")).alias("parts"))  # few rows a place
        .select(*GROUP, places.alias("parts"), count.alias("n"))
    )
    kept = [grouped.schema[name] for name in GROUP]
    schema = StructType([*kept, HOURLY["hourly_avg_value"]])
    return (
        grouped.mapInArrow(_divided, schema)
        .withColumns(calendar_parts(F.col("event_hour")))
        .select(*HOURLY.names)
    )


def _divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts, counts = (batch.column(n).to_pylist() for n in ("parts", "n"))
        averages = [average_of(p, n) for p, n in zip(parts, counts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in GROUP), pa.array(averages, pa.float64())],
            names=[*GROUP, "hourly_avg_value"],
        )


def average_of(parts: list[dict], count: int) -> float | None:
    """The exact sum over the count, rounded once: a quotient of integers is."""
    if not count:
        return None
    lowest = min((p["place"] for p in parts), default=0)
    total = sum(p["total"] << _BITS * (p["place"] - lowest) for p in parts)
    if lowest >= 0:
        return (total << _BITS * lowest) / count
    return total / (count << -_BITS * lowest)


def exact_hourly_avg(decoded: DataFrame, metrics: str | Iterable[str]) -> DataFrame:
    """``hourly_avg``, the same to the last bit however the rows are dealt out."""
    return exact_averages(exact_partials(hour_readings(decoded, metrics)))
