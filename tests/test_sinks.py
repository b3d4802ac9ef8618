import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from wellgauge import JdbcTarget, ReportSink
from wellgauge.operators import curate, partition_counts, preview
from wellgauge.schemas import CURATED, HOURLY, RAW
from wellgauge.sinks import overwrite_table, write_hourly, write_metrics, write_report
from wellgauge.sources import ensure_hourly, of_metric, read_curated, read_hourly


def hourly_rows(spark, *rows):
    return spark.createDataFrame(rows, HOURLY)


def raw_rows(spark, n):
    return spark.createDataFrame([("m", None, "x", None, str(i)) for i in range(n)], RAW)


def stored(spark, path):
    return {tuple(r) for r in read_hourly(spark, path).select(*HOURLY.names).collect()}


def test_only_given_hours_are_replaced(spark, tmp_path):
    path = str(tmp_path / "hourly")
    a, b = ("1", "a", 2021, 6, 1, 10, 1.0), ("1", "b", 2021, 6, 1, 10, 2.0)
    bad = (None, "a", None, None, None, None, None)
    write_hourly(hourly_rows(spark, a, b, bad), path)
    newer = ("1", "a", 2021, 6, 1, 10, 9.0)
    write_hourly(hourly_rows(spark, newer), path)
    assert stored(spark, path) == {newer, b, bad}


def test_one_file_per_hour(spark, tmp_path):
    path = str(tmp_path / "hourly")
    rows = [(str(w), "a", 2021, 6, 1, h, 1.0) for w in range(200) for h in range(5)]
    write_hourly(hourly_rows(spark, *rows).repartition(8), path, whole_table=True)
    assert len(read_hourly(spark, path).inputFiles()) == 5
    assert stored(spark, path) == set(rows)


def test_metric_names_stay_text(spark, tmp_path):
    path = str(tmp_path / "hourly")
    row = ("1", "007", 2021, 6, 1, 10, 1.0)
    write_hourly(hourly_rows(spark, row), path)
    assert stored(spark, path) == {row}


def test_reading_a_metric_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "hourly")
    a, b = ("1", "a", 2021, 6, 1, 10, 1.0), ("1", "b", 2021, 6, 1, 10, 2.0)
    write_hourly(hourly_rows(spark, a, b), path)
    metric = of_metric(read_hourly(spark, path), "a")
    assert metric.columns == HOURLY.names
    assert [tuple(r) for r in metric.collect()] == [a]
    assert "name#" in (plan := metric._jdf.queryExecution().toString())
    assert "PartitionFilters: [isnotnull(name" in plan


def test_an_ensured_table_is_empty_and_stays_what_it_is(spark, tmp_path):
    path = str(tmp_path / "hourly")
    ensure_hourly(spark, path)
    assert read_hourly(spark, path).isEmpty()
    row = ("1", "a", 2021, 6, 1, 10, 1.0)
    write_hourly(hourly_rows(spark, row), path)
    ensure_hourly(spark, path)
    assert stored(spark, path) == {row}


@pytest.fixture
def jdbc_calls(monkeypatch):
    """What would go to a database; none is started here."""
    calls = []

    def record(self, url, table, mode=None, properties=None):
        calls.append((url, table, mode, dict(properties), self._df))

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    return calls


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_one_database_table_per_metric(spark, tmp_path, jdbc_calls, mode):
    path = str(tmp_path / "hourly")
    a, b = ("1", "a", 2021, 6, 1, 10, 1.0), ("1", "b", 2021, 6, 1, 10, 2.0)
    write_hourly(hourly_rows(spark, a, b), path)
    target = JdbcTarget("jdbc:some:db", user="u", password="p", table_prefix="t_", connections=4)
    write_metrics(read_hourly(spark, path), target, ["a", "b", "none"], mode)
    assert [(u, t, m) for u, t, m, _, _ in jdbc_calls] == [
        ("jdbc:some:db", t, mode) for t in ("t_a", "t_b", "t_none")
    ]
    assert jdbc_calls[0][3] == {
        "user": "u",
        "password": "p",
        "numPartitions": "4",
        "batchsize": "10000",
    }
    assert [[tuple(r) for r in df.collect()] for *_, df in jdbc_calls] == [[a], [b], []]
    assert all(df.columns == HOURLY.names for *_, df in jdbc_calls)


def test_partition_counts(spark):
    raw = raw_rows(spark, 100).repartition(4)
    counts = partition_counts(raw, "read")
    assert counts.columns == ["partition_id", "count", "@timestamp", "stage"]
    assert dict(counts.dtypes) == {
        "partition_id": "int",
        "count": "bigint",
        "@timestamp": "string",
        "stage": "string",
    }
    rows = counts.collect()
    assert sum(r["count"] for r in rows) == 100
    assert {r.partition_id for r in rows} == set(range(4))
    assert {r.stage for r in rows} == {"read"}


def test_report_in_any_format(spark, tmp_path):
    """Landings add their rows by default; a sink can be told to keep the last ones."""
    path = {"path": str(tmp_path)}
    for sink, rows in ((ReportSink("parquet", path), 20), (ReportSink("parquet", path, "overwrite"), 10)):
        for _ in range(2):
            write_report(partition_counts(raw_rows(spark, 10), "read"), sink, "spark-read")
        back = spark.read.parquet(str(tmp_path / "spark-read"))
        assert back.agg(F.sum("count")).first()[0] == rows


def test_curated_copy_and_preview(spark, tmp_path):
    path = str(tmp_path / "curated")
    for _ in range(2):
        overwrite_table(curate(raw_rows(spark, 25)), path)
    curated = read_curated(spark, path)
    assert curated.schema == CURATED
    rows = curated.collect()
    assert len(rows) == 25
    assert len({r.timestamp for r in rows}) == 1
    assert all(r.partition_id is not None for r in rows)
    shown = preview(curated).collect()
    assert len(shown) == 10 and set(shown) <= set(rows)
