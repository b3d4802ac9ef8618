"""What the file sink of a stream says it has committed to a table."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wellgauge.sinks.folders import file_names, read_text, unescaped

# Where the sink keeps its log, and how it names and writes entries.
LOG_FOLDER = "_spark_metadata"
_NAME = re.compile(r"(\d+)(\.compact)?")


def latest_batch(spark: SparkSession, path: str) -> int:
    """Number of the last batch that the sink committed to the table; -1 for none."""
    return max(_logs(spark, path), default=-1)


def read_batches_after(
    spark: SparkSession, path: str, schema: StructType, batch_id: int
) -> DataFrame:
    """Rows of the batches that were committed after ``batch_id``; of all for -1.

    Which files these are is read from the sink's log, so only they are opened. The
    driver reads that log, as Spark's own does for every query over the table.
    """
    reader = spark.read.schema(schema)
    if batch_id < 0:
        return reader.parquet(path)
    logs = _logs(spark, path)
    files = _files(spark, path, logs, max(logs)) - _files(spark, path, logs, batch_id)
    names = [unescaped(spark, f) for f in sorted(files)]
    return reader.parquet(*names) if names else reader.parquet(path).filter(F.lit(False))


def _logs(spark: SparkSession, path: str) -> dict[int, str]:
    found = (_NAME.fullmatch(n) for n in file_names(spark, f"{path}/{LOG_FOLDER}"))
    return {int(m[1]): m[0] for m in sorted(filter(None, found), key=lambda m: m[0])}


def _files(spark: SparkSession, path: str, logs: dict[int, str], upto: int) -> set[str]:
    """Files committed up to a batch: those of its last compacted log and of the logs
    after it."""
    numbers = sorted(n for n in logs if n <= upto)
    first = max((n for n in numbers if logs[n].endswith(".compact")), default=-1)
    found = set()
    for number in numbers:
        if number >= first:
            lines = read_text(spark, f"{path}/{LOG_FOLDER}/{logs[number]}").splitlines()
            entries = map(json.loads, lines[1:])  # the first line is a version
            found |= {e["path"] for e in entries if not e.get("isDir")}
    return found
