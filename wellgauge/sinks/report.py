"""Count reports, in whatever format the user has a connector for."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wellgauge.config import ReportSink

# Formats that store a batch as a folder of its own, which can be replaced.
_FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "xml")


def write_report(report: DataFrame, sink: ReportSink, name: str) -> None:
    """Write to ``name`` in the sink: a path, or what the connector makes of it.

    Where reports are added to files, each ``batch_id`` of the report replaces what the
    sink has of that batch and leaves all others alone.
    """
    options = dict(sink.options)
    root = options.pop("path", None)
    target = f"{root.rstrip('/')}/{name}" if root else name
    writer, mode = report.write.format(sink.format), sink.mode
    if sink.format in _FILE_FORMATS and mode == "append" and "batch_id" in report.columns:
        mode = "overwrite"
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
    writer.options(**options).mode(mode).save(target)
