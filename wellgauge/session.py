"""Session settings the job depends on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_MIN_TASK_SIZE = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def job_session(spark: SparkSession) -> SparkSession:
    """Set what the job relies on in the session it is given.

    The zone is pinned to UTC, so that hours do not depend on where the job
    runs. Call this before building a plan: Spark fixes the zone of an
    expression when the expression is analysed.

    Hourly tables are many small files, so writing them takes time by the file
    and not by the byte. Adaptive execution should therefore not merge tasks
    below one per core for being small, unless the user wants it to.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(_MIN_TASK_SIZE, None) is None:
        spark.conf.set(_MIN_TASK_SIZE, "1KB")
    return spark


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared one that the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="wellgauge-")
    return f"{base.rstrip('/')}/wellgauge/{purpose}-{uuid.uuid4().hex}"
