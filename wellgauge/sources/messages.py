"""The message log, as a stream and as a bounded table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wellgauge.config import MessageSource
from wellgauge.schemas import MESSAGE_LOG
from wellgauge.sources.tables import ALL_FILES

# A first run takes the log from its start, and offsets that are gone are an error.
# Without a limit one task reads a whole topic partition, whatever share of the
# log that is. Spark splits a partition that holds more; nothing is left out.
_KAFKA = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "true",
    "maxRecordsPerPartition": "5000000",
}
# Options that only a streaming read of the log understands.
_STREAM_ONLY = ("maxoffsetspertrigger", "maxfileage")
# Formats that need to be told the schema; others bring their own.
_FILE_FORMATS = ("parquet", "orc", "avro")
_DEFAULTS = {"kafka": _KAFKA, **{name: ALL_FILES for name in _FILE_FORMATS}}


def reader_options(source: MessageSource, streaming: bool) -> dict[str, str]:
    """Options of the source over those it gets by default; case does not count in
    their names. A batch read takes the log from its start, wherever the stream
    was told to begin."""
    given = {k.lower() for k in source.options}
    defaults = {k: v for k, v in _DEFAULTS.get(source.format, {}).items() if k.lower() not in given}
    options = {**defaults, **source.options}
    if streaming:
        return options
    start = {"startingoffsets": "earliest"} if source.format == "kafka" else {}
    return {k: start.get(k.lower(), v) for k, v in options.items() if k.lower() not in _STREAM_ONLY}


def stream_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """The log as a stream. Where to start counts on the first run only; after
    that the checkpoint of the query decides."""
    return _load(spark.readStream, source, reader_options(source, streaming=True))


def read_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """Everything the log holds now."""
    return _load(spark.read, source, reader_options(source, streaming=False))


def _load(reader, source: MessageSource, options: dict[str, str]) -> DataFrame:
    if source.format in _FILE_FORMATS:
        reader = reader.schema(MESSAGE_LOG)
    return reader.format(source.format).options(**options).load()
