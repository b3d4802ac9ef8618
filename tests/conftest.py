import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Spark's Python workers load the fake message log from here.
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE), os.environ.get("PYTHONPATH", "")])

from wellgauge import JobConfig, Layout  # noqa: E402
from wellgauge.session import job_session  # noqa: E402

CORES = os.environ.get("TEST_CPUS", "8")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master(f"local[{CORES}]")
        .appName("wellgauge-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        # No checksum files: each costs a process here, see bench.py.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wellgauge-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def utc(spark):
    job_session(spark)


@pytest.fixture
def config(tmp_path):
    return JobConfig(Layout.under(str(tmp_path / "tables")))


@pytest.fixture
def messages(spark):
    """Texts (or bytes, or None) as message rows."""

    def build(values):
        rows = [(v.encode() if isinstance(v, str) else v,) for v in values]
        return spark.createDataFrame(rows, "value BINARY").select(
            F.lit(b"k").alias("key"), "value"
        )

    return build


@pytest.fixture
def log(spark, tmp_path):
    """A message log that grows: each call appends values as one more file."""
    from wellgauge.sources.replay import as_messages

    path = str(tmp_path / "log")

    def append(values):
        rows = [(i, v) for i, v in enumerate(values)]
        table = spark.createDataFrame(rows, "i LONG, value STRING")
        moment = F.lit("2021-06-01 00:00:00")
        as_messages(table, F.col("i"), F.col("value"), F.col("i"), moment).coalesce(1).write.mode(
            "append"
        ).parquet(path)
        return path

    return append
