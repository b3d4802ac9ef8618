"""Counts taken while landing, and reports that hold each batch once."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import message
from test_averages import sensor_messages
from wellgauge import METRICS, JobConfig, Layout, MessageSource, ReportSink
from wellgauge.plans import enrich, land, report, run_job
from wellgauge.sinks.folders import delete, unescaped
from wellgauge.sources import read_raw, stream_messages
from wellgauge.sources.sink_log import latest_batch, read_batches_after
from wellgauge.schemas import RAW
from wellgauge.streaming import READ_REPORT, REJECT_REPORT, WRITE_REPORT, counts, reporting


@pytest.fixture
def reported(config, tmp_path):
    return JobConfig(config.layout, report=ReportSink("parquet", {"path": str(tmp_path / "r")}))


def sums(spark, config):
    root = config.report.options["path"]
    totals = {
        name: spark.read.parquet(f"{root}/{name}").agg(F.sum("count")).first()[0]
        for name in (READ_REPORT, WRITE_REPORT)
    }
    rejects = spark.read.parquet(f"{root}/{REJECT_REPORT}").groupBy("name")
    by_name = rejects.agg(F.sum("messages"), F.sum("rejected")).collect()
    return totals, {r[0]: (r[1], r[2]) for r in by_name}


def arrive(spark, config, path):
    land(spark, config, stream_messages(spark, MessageSource("parquet", {"path": path})))
    enrich(spark, config)


TEXTS = [
    *(message(name=METRICS[i % 2], value=float(i)) for i in range(40)),
    *(message(name=METRICS[0], payload="oops") for _ in range(3)),
    message(name="another", payload="oops"),
    message(name="another"),
    message(name=None),
    "no message",
]
WANT = {METRICS[0]: (23, 3), METRICS[1]: (20, 0), None: (4, 1)}


def test_counts_by_partition_and_name(spark, reported, log):
    arrive(spark, reported, log(TEXTS))
    report(spark, reported)
    totals, names = sums(spark, reported)
    assert set(totals.values()) == {len(TEXTS)} and names == WANT
    rows = spark.read.parquet(f"{reported.report.options['path']}/{READ_REPORT}")
    assert set(rows.columns) == {
        "partition_id", "count", "@timestamp", "stage", "report_id", "batch_id"
    }
    assert rows.filter("partition_id is null or `@timestamp` is null").isEmpty()
    assert {r.stage for r in rows.collect()} == {"read"}


def test_a_repeated_batch_is_reported_once(spark, reported, log, monkeypatch):
    """The second of two reports fails after the first was written."""
    arrive(spark, reported, log(TEXTS))
    write = reporting.write_report

    def fail(rows, sink, name):
        if name == REJECT_REPORT:
            raise OSError("no space")
        write(rows, sink, name)

    for _ in range(2):
        with monkeypatch.context() as patch:
            patch.setattr(reporting, "write_report", fail)
            with pytest.raises(OSError):
                report(spark, reported)
    for _ in range(2):
        report(spark, reported)
        totals, names = sums(spark, reported)
        assert set(totals.values()) == {len(TEXTS)} and names == WANT


def test_reports_read_neither_table(spark, reported, log):
    arrive(spark, reported, log(TEXTS))
    for table in (reported.layout.raw, reported.layout.curated):
        for file in Path(table).glob("part-*"):
            file.rename(file.with_name("gone-" + file.name + ".bak"))
    report(spark, reported)
    totals, names = sums(spark, reported)
    assert set(totals.values()) == {len(TEXTS)} and names == WANT


def test_a_backlog_is_counted_batch_by_batch(spark, reported, log):
    for i in range(4):
        path = log(TEXTS[10 * i : 10 * i + 10])
    source = MessageSource("parquet", {"path": path, "maxFilesPerTrigger": "1"})
    land(spark, reported, stream_messages(spark, source))
    assert counts.stored_batches(spark, reported, "read") == [0, 1, 2, 3]
    report(spark, reported)
    assert counts.stored_batches(spark, reported, "read") == []
    assert counts.reported_upto(spark, reported, "read") == 3
    rows = spark.read.parquet(f"{reported.report.options['path']}/{READ_REPORT}")
    by_batch = rows.groupBy("batch_id").agg(F.sum("count").alias("n")).collect()
    assert {r.batch_id: r.n for r in by_batch} == dict.fromkeys(range(4), 10)


def test_what_a_broken_run_did_not_count_is_counted_by_the_next(spark, reported, log, monkeypatch):
    arrive(spark, reported, log(TEXTS[:10]))
    with monkeypatch.context() as patch:  # two landings whose counts get lost
        patch.setattr(counts.CountBook, "store", lambda self: None)
        arrive(spark, reported, log(TEXTS[10:20]))
        arrive(spark, reported, log(TEXTS[20:30]))
    arrive(spark, reported, log(TEXTS[30:]))
    assert counts.stored_batches(spark, reported, "read") == [0, 1, 2, 3]
    report(spark, reported)
    totals, names = sums(spark, reported)
    assert set(totals.values()) == {len(TEXTS)} and names == WANT


def test_counting_may_start_late(spark, config, reported, log):
    path = log(TEXTS[:20])
    arrive(spark, config, path)  # no report asked for
    arrive(spark, reported, log(TEXTS[20:]))
    report(spark, reported)
    totals, names = sums(spark, reported)
    assert set(totals.values()) == {len(TEXTS)} and names == WANT


def test_nothing_new_reports_nothing(spark, reported, log):
    path = log(TEXTS)
    for _ in range(3):
        arrive(spark, reported, path)
        report(spark, reported)
    totals, names = sums(spark, reported)
    assert set(totals.values()) == {len(TEXTS)} and names == WANT


def test_files_of_batches_by_the_log_of_the_sink(spark, config, log):
    """Compacted logs are taken apart again."""
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "3")
    try:
        for i in range(8):
            land(
                spark, config,
                stream_messages(spark, MessageSource("parquet", {"path": log([f"t{i}", "x"])})),
            )
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")
    assert latest_batch(spark, config.layout.raw) == 7
    assert list(Path(config.layout.raw, "_spark_metadata").glob("*.compact"))
    for known in range(-1, 8):
        rows = read_batches_after(spark, config.layout.raw, RAW, known)
        assert rows.count() == 2 * (7 - known)


def test_other_formats_get_all_rows_with_an_id(spark, config, log, tmp_path, monkeypatch):
    """A sink that cannot replace is told which rows are the same."""
    sink = ReportSink("parquet", {"path": str(tmp_path / "r")}, "overwrite")
    reported = JobConfig(config.layout, report=sink)
    arrive(spark, reported, log(TEXTS))
    report(spark, reported)
    ids = [r.report_id for r in spark.read.parquet(str(tmp_path / "r" / REJECT_REPORT)).collect()]
    assert len(ids) == len(set(ids)) == 3 and all(i.startswith("read-0-") for i in ids)


# --- the job around them ------------------------------------------------------------


@pytest.mark.parametrize("root", ["my tables", "100%25 sure", "a+b", "plain"])
def test_publish_sends_once_whatever_the_folder_is_called(
    spark, log, tmp_path, monkeypatch, root
):
    from pyspark.sql import DataFrameWriter

    from wellgauge import JdbcTarget
    from wellgauge.plans import publish

    tables = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, **_: tables.append(table))
    config = JobConfig(
        Layout.under(str(tmp_path / root)),
        source=MessageSource("parquet", {"path": log([message()])}),
        jdbc=JdbcTarget("jdbc:some:db"),
        report=ReportSink("parquet", {"path": str(tmp_path / root / "r")}),
    )
    run_job(spark, config)
    for _ in range(2):
        publish(spark, config)
    assert tables == ["well_pump_rpm"]
    spark.catalog.clearCache()
    assert sums(spark, config)[0] == {READ_REPORT: 1, WRITE_REPORT: 1}


def test_paths_of_files_that_spark_names(spark, tmp_path):
    path = str(tmp_path / "a b%+c")
    spark.range(1).coalesce(1).write.parquet(path)
    (name,) = spark.read.parquet(path).inputFiles()
    file = unescaped(spark, name).removeprefix("file:")
    assert Path(file).exists()
    assert delete(spark, [file, file]) == 1 and not Path(file).exists()


@pytest.mark.parametrize("which", ["start_curated", "start_hourly"])
def test_no_stream_is_left_when_one_does_not_start(spark, config, log, monkeypatch, which):
    from wellgauge.plans import job

    land(spark, config, stream_messages(spark, MessageSource("parquet", {"path": log(TEXTS)})))

    def fail(*_, **__):
        raise OSError("no folder")

    with monkeypatch.context() as patch:
        patch.setattr(job, which, fail)
        with pytest.raises(OSError):
            enrich(spark, config)
    assert not spark.streams.active
    enrich(spark, config)
    assert read_raw(spark, config.layout.raw).count() == len(TEXTS)


def test_sums_of_many_names_and_wells(spark, reported, log):
    texts = sensor_messages(11, 300)
    arrive(spark, reported, log(texts))
    report(spark, reported)
    totals, names = sums(spark, reported)
    assert set(totals.values()) == {len(texts)}
    assert sum(n for n, _ in names.values()) == len(texts)
