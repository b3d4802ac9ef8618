"""Messages to the raw table.

No shuffle: each task decodes a range of the log and writes it. The file sink
keeps a log of finished batches, so a row lands exactly once per log offset.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wellgauge.operators.decode import decode_envelope
from wellgauge.streaming.control import AVAILABLE_NOW, every


def start_landing(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping = AVAILABLE_NOW,
    decode: Callable[[DataFrame], DataFrame] = decode_envelope,
) -> StreamingQuery:
    """Append decoded messages to a Parquet table that nothing else writes.

    A later call with the same checkpoint goes on where the last one ended.
    """
    return (
        decode(messages)
        .writeStream.queryName(f"landing to {path}")
        .format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_console(
    table: DataFrame, trigger: Mapping = every("5 seconds"), truncate: bool = False
) -> StreamingQuery:
    """Print each batch on the driver; for looking, not for landing."""
    return (
        table.writeStream.format("console")
        .outputMode("append")
        .option("truncate", str(truncate).lower())
        .trigger(**trigger)
        .start()
    )
