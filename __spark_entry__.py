"""

The ``events`` table stands in for the sensors: each event becomes one JSON
message with the event type as metric name and the user as well. Queries that
land or write tables do so in a new folder below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.errors import StreamingQueryException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from wellgauge import JobConfig, Layout, MessageSource, ReportSink  # noqa: E402
from wellgauge.operators import (  # noqa: E402
    as_text,
    curate,
    decode_envelope,
    decode_nested,
    event_time_parts,
    exact_averages,
    exact_partials,
    hour_readings,
    hourly_avg,
    merge_exact,
    partition_counts,
    payload_profile,
    payload_schema,
    payload_value,
    preview,
    reject_counts,
    same_rows,
)
from wellgauge.operators.decode import decoded  # noqa: E402
from wellgauge.plans import (  # noqa: E402
    backfill,
    dump_messages,
    enrich,
    land,
    rebuild,
    report,
    run_job,
)
from wellgauge.schemas import HOURLY  # noqa: E402
from wellgauge.session import job_session, workspace  # noqa: E402
from wellgauge.sinks import append_table, overwrite_table, write_hourly  # noqa: E402
from wellgauge.sinks.folders import delete, touch  # noqa: E402
from wellgauge.sources import (  # noqa: E402
    of_metric,
    read_backfill,
    read_curated,
    read_hourly,
    read_messages,
    read_raw,
    read_rejects,
    stream_messages,
)
from wellgauge.sources.replay import as_messages, events_as_messages  # noqa: E402
from wellgauge.streaming import (  # noqa: E402
    READ_REPORT,
    REJECT_REPORT,
    WRITE_REPORT,
    await_all,
    every,
    read_gaps,
    read_live,
    run_for,
    start_curated,
    start_hourly,
    start_landing,
    start_live,
    write_pending_hours,
)

# The corpus operators are registered where they, and the packages they use, are
# installed; the job needs neither.
try:
    import corpus_pipeline
    from wellgauge.llm import queries as corpus_queries
except ModuleNotFoundError:
    corpus_pipeline = corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
EVENT_METRICS = ("signup", "purchase", "error", "view", "click")
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING"
)

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs -----------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_session(spark).read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_messages(_events(spark, sf_dir))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages as messages."""
    job_session(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    now = F.lit("2024-01-01 00:00:00")
    return as_messages(documents, F.col("doc_id"), F.col("text"), F.col("doc_id"), now).unionAll(
        as_messages(pages, F.col("page_id"), F.col("html"), F.col("page_id"), now)
    )


def _partitioned_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in four topic partitions, each numbered without gaps."""
    place = {"partition": (F.col("offset") % 4).cast("int"), "offset": F.expr("offset div 4")}
    return _messages(spark, sf_dir).withColumns(place)


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The braces make the path a pattern, which a stream needs to follow a
    # table that is a single file; a folder of files is found as well.
    events = job_session(spark).readStream.schema(EVENTS_SCHEMA)
    return events_as_messages(events.parquet(f"{sf_dir}/{{events.parquet}}"))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_envelope(_messages(spark, sf_dir))


def _raw_both_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event twice: once with its value, once with its props as payload."""
    events = _events(spark, sf_dir)
    props = decode_envelope(events_as_messages(events, F.col("props")))
    return decode_envelope(events_as_messages(events)).unionAll(props)


def _config(spark: SparkSession, purpose: str) -> JobConfig:
    return JobConfig(Layout.under(workspace(spark, purpose)), metrics=EVENT_METRICS)


def _rounded(hourly: DataFrame) -> DataFrame:
    # Summation order is not fixed, so the last digits of a sum are not either.
    return hourly.select(
        *HOURLY.names[:-1], F.round("hourly_avg_value", 6).alias("hourly_avg_value")
    )


# --- sources, projections ---------------------------------------------------


def decode_envelope_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir)


def decode_nested_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_nested(_messages(spark, sf_dir)).select(F.to_json("value").alias("value_json"))


def decode_junk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no JSON at all among messages: every one stays, those as rows of
    NULLs."""
    return decode_envelope(_texts(spark, sf_dir).unionByName(_messages(spark, sf_dir)))


def payload_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_value(_raw_both_payloads(spark, sf_dir)).select(
        "well_id", "name", "@timestamp", "value"
    )


def event_time_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_time_parts(_raw(spark, sf_dir)).select(
        "@timestamp", "name", "well_id", "year", "month", "day", "hour"
    )


def payload_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both payloads, and a third that repeats a key and holds a great integer."""
    repeated = F.concat(
        F.lit('{"user":"x","big":123456789012345678901234,"user":'), F.col("user_id"), F.lit("}")
    )
    third = decode_envelope(events_as_messages(_events(spark, sf_dir), repeated))
    return payload_profile(_raw_both_payloads(spark, sf_dir).unionAll(third))


def payload_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with objects in arrays, arrays in arrays, fields of one name only, and
    fields whose values differ in type."""
    number, view = F.col("event_id").cast("string"), F.col("event_type") == "view"
    parts = [
        F.lit('{"id":'),
        F.when(view, F.concat(F.lit('"v'), number, F.lit('"'))).otherwise(number),
        F.lit(',"seen":[{"at":"'),
        F.col("event_type"),
        F.lit('","n":'),
        (F.col("event_id") % 7).cast("string"),
        F.lit('},{"n":0.5,"more":{"x y":[]}}],"mixed":'),
        F.when(F.col("event_id") % 2 == 0, '"t"').otherwise("[1]"),
        F.lit(',"deep":{"er":[['),
        F.col("user_id").cast("string"),
        F.lit(']],"flag":true},"'),
        F.col("event_type"),
        F.lit('_only":null}'),
    ]
    nested = events_as_messages(_events(spark, sf_dir), F.concat(*parts))
    return payload_schema(decode_envelope(nested), EVENT_METRICS)


def reject_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_raw_both_payloads(spark, sf_dir))


def raw_dump_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "raw_dump")
    dump_messages(_messages(spark, sf_dir), path)
    return spark.read.schema("key STRING, value STRING").parquet(path)


def message_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_messages(spark, sf_dir))


# --- aggregation ------------------------------------------------------------


def _hourly_avg_query(metric: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(hourly_avg(payload_value(_raw(spark, sf_dir)), metric))

    return query


def hourly_avg_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(hourly_avg(payload_value(_raw(spark, sf_dir)), EVENT_METRICS))


def hourly_avg_exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of all metrics from exact sums, in one piece and merged from three, and
    whether both are the same to the last bit."""
    events = _events(spark, sf_dir)

    def partials(part: DataFrame) -> DataFrame:
        decoded = payload_value(decode_envelope(events_as_messages(part)))
        return exact_partials(hour_readings(decoded, EVENT_METRICS))

    thirds = [partials(events.filter(F.col("event_id") % 3 == i)) for i in range(3)]
    merged = merge_exact(thirds[0].unionAll(thirds[1]).unionAll(thirds[2]))
    split = exact_averages(merged).withColumnRenamed("hourly_avg_value", "from_parts")
    both = exact_averages(partials(events)).join(split, HOURLY.names[:-1])
    same = F.col("hourly_avg_value").eqNullSafe(F.col("from_parts"))
    average = F.round("hourly_avg_value", 6).alias("hourly_avg_value")
    return both.select(*HOURLY.names[:-1], average, same.alias("same"))


def partition_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of both stages. Which partitions there are depends on the cluster,
    so only what does not is returned."""
    raw = _raw(spark, sf_dir)
    counts = partition_counts(raw, "read").unionAll(partition_counts(curate(raw), "write"))
    return counts.groupBy("stage").agg(
        F.sum("count").alias("messages"),
        (F.count("partition_id") == F.count_distinct("partition_id")).alias("one_row_each"),
        (F.count("@timestamp") == F.count(F.lit(1))).alias("all_stamped"),
    )


# --- sinks ------------------------------------------------------------------


def _stored_copy(spark: SparkSession, sf_dir: str, purpose: str) -> DataFrame:
    path = workspace(spark, purpose)
    overwrite_table(curate(_raw(spark, sf_dir)), path)
    return read_curated(spark, path)


def _without_run(curated: DataFrame) -> DataFrame:
    """Partition ids and load times differ from run to run; that they are there
    does not."""
    return curated.select(
        "@metadata",
        "@timestamp",
        "name",
        "payload",
        "well_id",
        F.col("partition_id").isNotNull().alias("has_partition_id"),
        F.col("timestamp").isNotNull().alias("has_load_time"),
    )


def curate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_run(_stored_copy(spark, sf_dir, "curate"))


def preview_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten rows may be shown: how many there are, and how many different ones of
    them the table holds."""
    stored, path = _stored_copy(spark, sf_dir, "preview"), workspace(spark, "previewed")
    overwrite_table(preview(stored), path)
    shown = read_curated(spark, path).select(F.struct("*").alias("shown"))  # ten rows
    known = (
        stored.select(F.struct("*").alias("row"))
        .join(F.broadcast(shown.distinct()), F.col("row").eqNullSafe(F.col("shown")), "left_semi")
        .distinct()
    )
    return (
        shown.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("shown").alias("different"))
        .join(F.broadcast(known.agg(F.count(F.lit(1)).alias("known"))))
        .select("rows", (F.col("known") == F.col("different")).alias("all_known"))
    )


def ingest_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a stored log, read as a bounded table and written nested."""
    log, path = workspace(spark, "log"), workspace(spark, "ingest_batch")
    append_table(_messages(spark, sf_dir), log)
    backfill(read_messages(spark, MessageSource("parquet", {"path": log})), path)
    return read_backfill(spark, path).select("value.*")


def hourly_readback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "hourly_readback")
    write_hourly(hourly_avg(payload_value(_raw(spark, sf_dir)), EVENT_METRICS), path)
    return _rounded(read_hourly(spark, path))


def hourly_relation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric as the job handles it: average, store, and read back the rows
    that its database table gets."""
    path = workspace(spark, "hourly_relation")
    write_hourly(hourly_avg(payload_value(_raw(spark, sf_dir)), "error"), path)
    return _rounded(of_metric(read_hourly(spark, path), "error"))


def rebuild_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land in one go, then enrich the whole raw table as a batch."""
    layout = _config(spark, "rebuild").layout
    append_table(_raw(spark, sf_dir), layout.raw)
    rebuild(read_raw(spark, layout.raw), layout.curated, layout.hourly, EVENT_METRICS)
    return _rounded(read_hourly(spark, layout.hourly))


# --- streaming --------------------------------------------------------------


def ingest_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "ingest_stream")
    land(spark, config, _message_stream(spark, sf_dir))
    return read_raw(spark, config.layout.raw)


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All messages in two parts: the second holds the last days and, late, the
    lowest readings of all days before."""
    events = _events(spark, sf_dir)
    second = (F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")) | (F.col("value") < 0.25)
    second = F.coalesce(second, F.lit(True))
    return [events_as_messages(events.filter(~second)), events_as_messages(events.filter(second))]


def decode_rejects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages among messages, landed in two runs: none decodes, and all are
    kept byte for byte, with their place and the reason."""
    config, log = _config(spark, "decode_rejects"), workspace(spark, "log")
    source = MessageSource("parquet", {"path": log})
    for part in (_messages(spark, sf_dir), _texts(spark, sf_dir)):
        append_table(part, log)
        land(spark, config, stream_messages(spark, source))
    return read_rejects(spark, config.layout.rejects).select(
        F.col("key").cast("string").alias("key"),
        "topic",
        "partition",
        "offset",
        "reason",
        F.octet_length("value").alias("bytes"),
        F.sha2("value", 256).alias("value_sha256"),
    )


def offset_gaps_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a log lacks, noted while it lands in two runs; some is gone between them."""
    config, log = _config(spark, "offset_gaps"), workspace(spark, "log")
    config = replace(config, check_offsets=True)
    source = MessageSource("parquet", {"path": log})
    number = F.col("offset")
    kept = _partitioned_messages(spark, sf_dir).filter(
        ~(number % 211).between(40, 45) & (number % 1000 != 7)
    )
    for part in (number < 100, number >= 125):
        append_table(kept.filter(part), log)
        land(spark, config, stream_messages(spark, source))
    return read_gaps(spark, config)


def landing_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether what landed is what was sent, by name: of the landed table, and of a copy
    that has one payload changed."""
    config = _config(spark, "landing_audit")
    land(spark, config, _message_stream(spark, sf_dir))
    sent = _raw(spark, sf_dir)
    altered = _messages(spark, sf_dir).select("offset", decoded("value").alias("v"))
    changed = F.when(F.col("offset") == 1, F.concat("payload", F.lit(" "))).otherwise(F.col("payload"))
    altered = altered.select("offset", "v.*").withColumn("payload", changed).drop("offset")
    copies = {"landed": read_raw(spark, config.layout.raw), "altered": altered}
    landed, other = (
        same_rows(copy, sent, ["name"]).select(F.lit(name).alias("copy"), "*")
        for name, copy in copies.items()
    )
    return landed.unionByName(other)


def failed_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one stream has landed when another one, beside it, fails on a message: the
    failure reaches the caller and stops the first."""
    config, other = (_config(spark, n) for n in ("failed_stream", "failing_stream"))

    def failing(messages: DataFrame) -> DataFrame:
        stop = F.raise_error(F.lit("a message that stops the stream")).cast("string")
        whole = decode_envelope(messages)
        return whole.withColumn("name", F.when(F.col("name") == "error", stop).otherwise(F.col("name")))

    landing = start_landing(
        _message_stream(spark, sf_dir), config.layout.raw, config.landing_checkpoint, every("1 second")
    )
    landing.processAllAvailable()
    broken = start_landing(
        _message_stream(spark, sf_dir), other.layout.raw, other.landing_checkpoint, decode=failing
    )
    try:
        await_all(landing, broken)
    except StreamingQueryException as error:
        failure = error
    else:
        raise RuntimeError("a failed stream was not noticed")
    if landing.isActive or "stops the stream" not in str(failure):
        raise RuntimeError("the other stream goes on, or another error came through")
    return read_raw(spark, config.layout.raw)


def ingest_resume_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: a first part, the rest, nothing new."""
    config, log = _config(spark, "ingest_resume"), workspace(spark, "log")
    source = MessageSource("parquet", {"path": log})
    for part in [*_arrivals(spark, sf_dir), None]:
        if part is not None:
            append_table(part, log)
        land(spark, config, stream_messages(spark, source))
    return read_raw(spark, config.layout.raw)


def stream_hourly_avg_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals; the second brings new hours and late readings for old ones."""
    config, log = _config(spark, "stream_hourly_avg"), workspace(spark, "log")
    source = MessageSource("parquet", {"path": log})
    for part in _arrivals(spark, sf_dir):
        append_table(part, log)
        messages = stream_messages(spark, source)
        await_all(start_landing(messages, config.layout.raw, config.landing_checkpoint))
        await_all(start_hourly(spark, config))
    return _rounded(read_hourly(spark, config.layout.hourly))


def stream_hourly_late_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most messages in one arrival, then some late ones of every day in three more. Each
    adds a small delta to the sums of its days; hours are written once, at the end."""
    config, log = _config(spark, "stream_hourly_late"), workspace(spark, "log")
    source = MessageSource("parquet", {"path": log})
    events = _events(spark, sf_dir)
    late = F.least(F.pmod(F.xxhash64("ts", "user_id"), F.lit(50)), F.lit(3))
    for part in (3, 0, 1, 2):
        append_table(events_as_messages(events.filter(late == part)), log)
        land(spark, config, stream_messages(spark, source))
        averages = start_hourly(spark, config, hours_each_batch=False)
        await_all(averages)
    write_pending_hours(spark, config, averages)
    return _rounded(read_hourly(spark, config.layout.hourly))


def stream_live_avg_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages as they stand after three arrivals and restarts, in order of time but for
    an hour of disorder. Some messages have no usable time; they are averaged as well."""
    config, log = _config(spark, "stream_live_avg"), workspace(spark, "log")
    source = MessageSource("parquet", {"path": log})
    events = _events(spark, sf_dir)
    # Readings of a quarter of the wells arrive up to an hour early.
    early = F.when(F.col("user_id") % 4 == 0, F.expr("ts - interval 1 hour")).otherwise(F.col("ts"))
    first, second = (early >= F.lit(day).cast("timestamp_ntz") for day in ("2024-01-13", "2024-01-23"))
    stamp = F.regexp_replace(F.col("value").cast("string"), '"@timestamp":"[^"]*"', '"@timestamp":"?"')
    untimed = F.when(F.col("offset") % 50 == 0, stamp.cast("binary")).otherwise(F.col("value"))
    for part in (~first, first & ~second, second):
        append_table(events_as_messages(events.filter(part)).withColumn("value", untimed), log)
        land(spark, config, stream_messages(spark, source))
        await_all(*start_live(spark, config, delay="2 hours"))
    average = F.round("hourly_avg_value", 6).alias("hourly_avg_value")
    return read_live(spark, config).select(*HOURLY.names[:-1], average, "readings")


def stream_hourly_reset_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint of the averages is lost after the first arrival: a new one starts
    with no sums and builds the hours from raw again."""
    config, log = _config(spark, "stream_hourly_reset"), workspace(spark, "log")
    source = MessageSource("parquet", {"path": log})
    other = replace(config.layout, checkpoints=workspace(spark, "other-checkpoints"))
    for part, layout in zip(_arrivals(spark, sf_dir), (config.layout, other), strict=True):
        append_table(part, log)
        land(spark, config, stream_messages(spark, source))
        await_all(start_hourly(spark, replace(config, layout=layout)))
    return _rounded(read_hourly(spark, config.layout.hourly))


def ingest_interval_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing at an interval, stopped after a limited time."""
    config = _config(spark, "ingest_interval")
    query = start_landing(
        _message_stream(spark, sf_dir),
        config.layout.raw,
        config.landing_checkpoint,
        every("1 second"),
    )
    query.processAllAvailable()
    if run_for(query, 2):
        raise RuntimeError("a stream at an interval does not end by itself")
    return read_raw(spark, config.layout.raw)


def report_readback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of two landings, and of a run that brings nothing, summed up. In the first
    the second of two reports cannot be written at first, so its batch is repeated."""
    config, log = _config(spark, "report"), workspace(spark, "log")
    reports = workspace(spark, "reports")
    config = replace(config, report=ReportSink("parquet", {"path": reports}))
    source = MessageSource("parquet", {"path": log})
    parts = [*_arrivals(spark, sf_dir), None]
    for part in parts:
        if part is not None:
            append_table(part, log)
        land(spark, config, stream_messages(spark, source))
        enrich(spark, config)
        if part is parts[0]:
            _report_to_a_blocked_sink(spark, config, f"{reports}/{REJECT_REPORT}")
        report(spark, config)
    counts = spark.read.parquet(f"{reports}/{READ_REPORT}").unionByName(
        spark.read.parquet(f"{reports}/{WRITE_REPORT}")
    )
    rejects = spark.read.parquet(f"{reports}/{REJECT_REPORT}")
    by_stage = counts.groupBy("stage", F.lit("").alias("name")).agg(
        F.sum("count").alias("messages"), F.lit(0).cast("long").alias("rejected")
    )
    by_name = rejects.groupBy(F.lit("rejects").alias("stage"), "name").agg(
        F.sum("messages").alias("messages"), F.sum("rejected").alias("rejected")
    )
    return by_stage.unionByName(by_name)


def _report_to_a_blocked_sink(spark: SparkSession, config: JobConfig, place: str) -> None:
    """A file stands where one of the reports should go."""
    touch(spark, place)
    try:
        report(spark, config)
    except Exception:  # whatever the file system says to that
        delete(spark, [place])
    else:
        raise RuntimeError("a report was written over a file")


def stream_curated_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "stream_curated")
    land(spark, config, _message_stream(spark, sf_dir))
    await_all(start_curated(spark, config))
    return _without_run(read_curated(spark, config.layout.curated))


def land_then_enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: land the log as a stream, then curate and average."""
    config = _config(spark, "land_then_enrich")
    run_job(spark, config, _message_stream(spark, sf_dir))
    return _rounded(read_hourly(spark, config.layout.hourly))


# --- contract ---------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return land_then_enrich_query(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    corpus = {} if corpus_queries is None else corpus_queries.queries()
    if corpus_pipeline is not None and corpus:
        corpus["pipeline"] = corpus_pipeline.run
    return {
        **corpus,
        "message_text": message_text_query,
        "decode_envelope": decode_envelope_query,
        "decode_nested": decode_nested_query,
        "decode_junk": decode_junk_query,
        "payload_value": payload_value_query,
        "event_time_parts": event_time_parts_query,
        "payload_profile": payload_profile_query,
        "payload_schema": payload_schema_query,
        "reject_counts": reject_counts_query,
        "raw_dump": raw_dump_query,
        **{f"hourly_avg_{metric}": _hourly_avg_query(metric) for metric in EVENT_METRICS},
        "hourly_avg_all": hourly_avg_all_query,
        "hourly_avg_exact": hourly_avg_exact_query,
        "partition_counts": partition_counts_query,
        "curate": curate_query,
        "preview": preview_query,
        "ingest_batch": ingest_batch_query,
        "hourly_readback": hourly_readback_query,
        "hourly_relation": hourly_relation_query,
        "rebuild": rebuild_query,
        "ingest_stream": ingest_stream_query,
        "ingest_resume": ingest_resume_query,
        "ingest_interval": ingest_interval_query,
        "failed_stream": failed_stream_query,
        "decode_rejects": decode_rejects_query,
        "offset_gaps": offset_gaps_query,
        "landing_audit": landing_audit_query,
        "report_readback": report_readback_query,
        "stream_hourly_avg": stream_hourly_avg_query,
        "stream_hourly_late": stream_hourly_late_query,
        "stream_live_avg": stream_live_avg_query,
        "stream_hourly_reset": stream_hourly_reset_query,
        "stream_curated": stream_curated_query,
        "land_then_enrich": land_then_enrich_query,
    }


def oracle_sql() -> dict[str, str]:
    """The same results in SQL."""
    stamp = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
    payload = "CAST(to_json({'value': value}) AS VARCHAR)"
    envelope = f"""
        SELECT 'replay' AS "@metadata", {stamp} AS "@timestamp", event_type AS name,
               {payload} AS payload, CAST(user_id AS VARCHAR) AS well_id
        FROM events"""
    nested = f"""CAST(to_json({{'@metadata': 'replay', '@timestamp': {stamp},
        'name': event_type, 'payload': {payload},
        'well_id': CAST(user_id AS VARCHAR)}}) AS VARCHAR)"""
    message = f"""
        SELECT CAST(user_id AS VARCHAR) AS key, {nested} AS value FROM events"""

    def hourly(where: str = "TRUE") -> str:
        return f"""
            SELECT CAST(user_id AS VARCHAR) AS well_id, event_type AS name,
                   CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                   CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
                   round(avg(value), 6) AS hourly_avg_value
            FROM events WHERE {where} GROUP BY ALL"""

    # Fields and JSON types of both payloads of each event, by DuckDB's own
    # JSON functions.
    payload_fields = f"""
        SELECT f.field, json_type(payload, '$.' || f.field) AS kind
        FROM (SELECT {payload} AS payload FROM events
              UNION ALL SELECT props AS payload FROM events) AS p,
             unnest(json_keys(p.payload)) AS f(field)"""
    corpus = {} if corpus_queries is None else corpus_queries.oracle_sql()
    return {
        **corpus,
        "message_text": message,
        "decode_envelope": envelope,
        "decode_nested": f"SELECT {nested} AS value_json FROM events",
        "decode_junk": f"""
            {envelope} UNION ALL
            SELECT CAST(NULL AS VARCHAR) AS "@metadata", CAST(NULL AS VARCHAR) AS "@timestamp",
                   CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS payload,
                   CAST(NULL AS VARCHAR) AS well_id
            FROM (SELECT text AS value FROM documents UNION ALL SELECT html FROM pages)""",
        "payload_value": f"""
            SELECT CAST(user_id AS VARCHAR) AS well_id, event_type AS name,
                   {stamp} AS "@timestamp",
                   CAST(json_extract_string(payload, '$.value') AS DOUBLE) AS value
            FROM (SELECT *, {payload} AS payload FROM events
                  UNION ALL SELECT *, props AS payload FROM events)""",
        "event_time_parts": f"""
            SELECT {stamp} AS "@timestamp", event_type AS name,
                   CAST(user_id AS VARCHAR) AS well_id,
                   CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                   CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
            FROM events""",
        "payload_profile": f"""
            SELECT 'big' AS field, count(*) AS messages, CAST(0 AS BIGINT) AS integers,
                   count(*) AS big_integers, CAST(0 AS BIGINT) AS fractions,
                   CAST(0 AS BIGINT) AS booleans, CAST(0 AS BIGINT) AS texts,
                   CAST(0 AS BIGINT) AS objects, CAST(0 AS BIGINT) AS arrays,
                   'DECIMAL' AS inferred_type FROM events
            UNION ALL
            SELECT 'user', count(*), count(*), 0, 0, 0, 0, 0, 0, 'BIGINT' FROM events
            UNION ALL
            SELECT field, messages, integers, CAST(0 AS BIGINT) AS big_integers, fractions,
                   booleans, texts, objects, arrays,
                   CASE WHEN fractions > 0 AND integers + fractions = messages THEN 'DOUBLE'
                        WHEN integers = messages THEN 'BIGINT'
                        ELSE 'STRING' END AS inferred_type
            FROM (SELECT field, count(*) AS messages,
                         count(*) FILTER (kind IN ('BIGINT', 'UBIGINT')) AS integers,
                         count(*) FILTER (kind = 'DOUBLE') AS fractions,
                         count(*) FILTER (kind = 'BOOLEAN') AS booleans,
                         count(*) FILTER (kind = 'VARCHAR') AS texts,
                         count(*) FILTER (kind = 'OBJECT') AS objects,
                         count(*) FILTER (kind = 'ARRAY') AS arrays
                  FROM ({payload_fields}) GROUP BY field)""",
        "payload_schema": """
            SELECT name, replace(tree.fullkey, '[0]', '[]') AS path,
                   CASE tree.type WHEN 'VARCHAR' THEN
                       CASE tree.value ->> '$' WHEN 'VARCHAR' THEN 'STRING'
                            WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'JSON' THEN 'MIXED'
                            ELSE tree.value ->> '$' END
                   ELSE tree.type END AS kind
            FROM (SELECT event_type AS name, json_group_structure(CAST(
                      '{"id":' || CASE WHEN event_type = 'view' THEN '"v' || event_id || '"'
                                       ELSE CAST(event_id AS VARCHAR) END
                      || ',"seen":[{"at":"' || event_type || '","n":' || event_id % 7
                      || '},{"n":0.5,"more":{"x y":[]}}],"mixed":'
                      || CASE WHEN event_id % 2 = 0 THEN '"t"' ELSE '[1]' END
                      || ',"deep":{"er":[[' || user_id || ']],"flag":true},"' || event_type
                      || '_only":null}' AS JSON)) AS found
                  FROM events GROUP BY event_type) AS types, json_tree(types.found) AS tree""",
        "reject_counts": f"""
            SELECT event_type AS name, count(*) AS messages,
                   count(*) FILTER (
                       payload IS NOT NULL AND json_extract(payload, '$.value') IS NULL
                   ) AS rejected
            FROM (SELECT event_type, {payload} AS payload FROM events
                  UNION ALL SELECT event_type, props FROM events)
            GROUP BY event_type""",
        "raw_dump": message,
        **{f"hourly_avg_{m}": hourly(f"event_type = '{m}'") for m in EVENT_METRICS},
        "hourly_avg_all": hourly(),
        "hourly_avg_exact": f"SELECT *, TRUE AS same FROM ({hourly()})",
        "partition_counts": """
            SELECT stage, (SELECT count(*) FROM events) AS messages,
                   TRUE AS one_row_each, TRUE AS all_stamped
            FROM (VALUES ('read'), ('write')) AS s(stage)""",
        "curate": f"""
            SELECT *, TRUE AS has_partition_id, TRUE AS has_load_time FROM ({envelope})""",
        "preview": """
            SELECT least(count(*), 10) AS rows, TRUE AS all_known FROM events""",
        "ingest_batch": envelope,
        "hourly_readback": hourly(),
        "hourly_relation": hourly("event_type = 'error'"),
        "rebuild": hourly(),
        "ingest_stream": envelope,
        "ingest_resume": envelope,
        "ingest_interval": envelope,
        "failed_stream": envelope,
        "decode_rejects": """
            SELECT CAST(id AS VARCHAR) AS key, 'replay' AS topic, 0 AS partition,
                   id AS "offset",
                   CASE WHEN value IS NULL THEN 'no value'
                        WHEN NOT regexp_matches(value, '\\S') THEN 'blank'
                        WHEN NOT json_valid(value) THEN 'no JSON'
                        WHEN json_type(value) = 'OBJECT' THEN 'an object without a known field'
                        WHEN json_type(value) = 'ARRAY' THEN 'an array'
                        ELSE 'a value without fields' END AS reason,
                   CAST(octet_length(encode(value)) AS INTEGER) AS bytes,
                   sha256(value) AS value_sha256
            FROM (SELECT doc_id AS id, text AS value FROM documents
                  UNION ALL SELECT page_id, html FROM pages)""",
        "offset_gaps": """
            SELECT 'replay' AS topic, CAST(p AS INTEGER) AS partition, before + 1 AS gap_start,
                   o - 1 AS gap_end, o - before - 1 AS missing
            FROM (SELECT p, o, lag(o) OVER (PARTITION BY p ORDER BY o) AS before
                  FROM (SELECT event_id % 4 AS p, event_id // 4 AS o FROM events)
                  WHERE NOT o % 211 BETWEEN 40 AND 45 AND o % 1000 <> 7
                        AND NOT o BETWEEN 100 AND 124)
            WHERE o > before + 1""",
        "landing_audit": """
            SELECT 'landed' AS copy, event_type AS name, count(*) AS copied,
                   count(*) AS original, TRUE AS same FROM events GROUP BY event_type
            UNION ALL
            SELECT 'altered', event_type, count(*), count(*), NOT bool_or(event_id = 1)
            FROM events GROUP BY event_type""",
        "report_readback": f"""
            SELECT stage, '' AS name, count(*) AS messages, CAST(0 AS BIGINT) AS rejected
            FROM events, (VALUES ('read'), ('write')) AS s(stage) GROUP BY stage
            UNION ALL
            SELECT 'rejects', event_type, count(*),
                   count(*) FILTER (json_extract({payload}, '$.value') IS NULL)
            FROM events GROUP BY event_type""",
        "stream_hourly_avg": hourly(),
        "stream_hourly_late": hourly(),
        "stream_live_avg": """
            SELECT well_id, name, year, month, day, hour,
                   round(avg(value), 6) AS hourly_avg_value, count(*) AS readings
            FROM (SELECT CAST(user_id AS VARCHAR) AS well_id, event_type AS name, value,
                         CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month,
                         CAST(day(t) AS INTEGER) AS day, CAST(hour(t) AS INTEGER) AS hour
                  FROM (SELECT *, CASE WHEN event_id % 50 <> 0 THEN ts END AS t FROM events))
            GROUP BY ALL""",
        "stream_hourly_reset": hourly(),
        "stream_curated": f"""
            SELECT *, TRUE AS has_partition_id, TRUE AS has_load_time FROM ({envelope})""",
        "land_then_enrich": hourly(),
    }
