"""Averages of open hours while they fill, for a look at what goes on.

Two streams over raw add readings up in state. One has a window per hour and a watermark:
an hour stays open until the newest event time is ``delay`` beyond its end, then its state
goes; readings for it that come later are left to the hourly table, which drops none, and
are counted (``late_readings``). The other adds up readings without a usable event time,
which no window takes; its state is a row per well and metric.

Both hand over the groups that changed (update mode). A batch's rows are stored under its
number, and the newest row of each group counts, so a repeated batch changes nothing.
Every tenth batch stores the newest rows of all groups and lets older files go.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wellgauge.config import JobConfig
from wellgauge.functions import calendar_parts, event_time
from wellgauge.operators.decode import payload_value
from wellgauge.schemas import HOURLY, LIVE
from wellgauge.sinks.folders import delete, exists, subfolders
from wellgauge.sources.tables import stream_raw
from wellgauge.streaming.control import AVAILABLE_NOW, start_all

DELAY = "2 hours"
_SNAPSHOT = 10  # batches between stores of all groups
_TIMED, _UNTIMED = "timed", "untimed"


def start_live(
    spark: SparkSession, config: JobConfig, delay: str = DELAY, trigger: Mapping = AVAILABLE_NOW
) -> list[StreamingQuery]:
    """Follow the raw table. Both queries go on from their checkpoints."""
    moment = event_time(F.col("@timestamp"))
    readings = (
        payload_value(stream_raw(spark, config.layout.raw, config.raw_options))
        .filter(F.col("name").isin(list(config.metrics)))
        .select("well_id", "name", moment.alias("moment"), "value")
    )
    timed = (
        readings.filter("moment is not null")
        .withWatermark("moment", delay)
        .groupBy("well_id", "name", F.window("moment", "1 hour").alias("hour"))
    )
    untimed = readings.filter("moment is null").groupBy("well_id", "name")
    return start_all(
        lambda: _start(timed, F.col("hour.start"), _TIMED, config, trigger),
        lambda: _start(untimed, F.lit(None).cast("timestamp"), _UNTIMED, config, trigger),
    )


def _start(grouped, hour, part: str, config: JobConfig, trigger: Mapping) -> StreamingQuery:
    path = f"{config.live_path}/part={part}"

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, path)

    averages = grouped.agg(
        F.avg("value").alias("hourly_avg_value"), F.count(F.lit(1)).alias("readings")
    )
    return (
        averages.select("well_id", "name", hour.alias("event_hour"), "hourly_avg_value", "readings")
        .writeStream.queryName(f"live {part} to {path}")
        .outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", config.live_checkpoint(part))
        .trigger(**trigger)
        .start()
    )


def store_batch(updates: DataFrame, batch_id: int, path: str) -> None:
    """Store the groups that a batch changed, in place of what was stored for it."""
    spark = updates.sparkSession
    rows = updates
    earlier = [b for b in _batches(spark, path) if b < batch_id]
    if earlier and batch_id % _SNAPSHOT == 0:
        stored = _newest(_stored(spark, path, earlier))
        rows = _newest(
            updates.withColumn("batch_id", F.lit(batch_id)).unionByName(
                stored.withColumn("batch_id", F.lit(-1))
            )
        )
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    if batch_id % _SNAPSHOT == 0:
        # All that the snapshot before this one holds; a repeat of this batch begins there.
        gone = [b for b in earlier if b < batch_id - _SNAPSHOT]
        delete(spark, [f"{path}/batch_id={b}" for b in gone])


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in subfolders(spark, path))


def _stored(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    folders = [f"{path}/batch_id={b}" for b in batches]
    return spark.read.schema(LIVE).option("basePath", path).parquet(*folders)


def _newest(rows: DataFrame) -> DataFrame:
    values = F.max_by(F.struct("hourly_avg_value", "readings"), "batch_id").alias("v")
    return rows.groupBy("well_id", "name", "event_hour").agg(values).select(
        "well_id", "name", "event_hour", "v.*"
    )


def read_live(spark: SparkSession, config: JobConfig) -> DataFrame:
    """The averages as they are now, in the columns of the hourly table, and how many
    readings each has seen."""
    parts = [f"{config.live_path}/part={p}" for p in (_TIMED, _UNTIMED)]
    tables = [
        _stored(spark, path, batches)
        for path in parts
        if exists(spark, path) and (batches := _batches(spark, path))
    ]
    rows = spark.createDataFrame([], LIVE)
    for table in tables:
        rows = rows.unionByName(table)
    return (
        _newest(rows)
        .withColumns(calendar_parts(F.col("event_hour")))
        .select(*HOURLY.names, "readings")
    )


def late_readings(query: StreamingQuery) -> int:
    """Readings of the last batches that came after their hour was closed."""
    operators = (o for p in query.recentProgress for o in p.stateOperators)
    return sum(o.numRowsDroppedByWatermark for o in operators)
