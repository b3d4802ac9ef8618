"""Settings of a job: where messages come from, where tables go, which metrics.

Nothing here holds a secret by default. ``JobConfig.from_spark`` reads ordinary
``--conf spark.wellgauge.*`` keys; the database password comes from the
environment.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

CONF_PREFIX = "spark.wellgauge."
PASSWORD_VARIABLE = "WELLGAUGE_JDBC_PASSWORD"

# The metric names that get hourly averages.
METRICS = (
    "well_pipe_pressure",
    "well_generator_temperature",
    "well_natural_gas",
    "well_generator_power",
    "well_crude_oil",
    "well_pump_temperature",
    "well_pipe_temperature",
    "well_pump_horse_power",
    "well_pump_rpm",
)


@dataclass(frozen=True)
class MessageSource:
    """A Spark source that yields ``schemas.MESSAGE_LOG`` rows."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def kafka(
        cls,
        servers: str,
        topic: str,
        *,
        starting_offsets: str = "earliest",
        fail_on_data_loss: bool = True,
        max_offsets_per_trigger: int | None = None,
        min_partitions: int | None = None,
        **extra: str,
    ) -> MessageSource:
        """One topic of a Kafka cluster.

        ``starting_offsets`` counts on the first run only; later runs go on from
        the checkpoint. ``max_offsets_per_trigger`` cuts a long backlog into
        several batches. ``min_partitions`` asks for at least so many tasks; a
        topic partition with very many messages is split over several in any
        case, see ``sources.messages``.
        """
        options = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
            **extra,
        }
        if max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        if min_partitions is not None:
            options["minPartitions"] = str(min_partitions)
        return cls("kafka", options)


@dataclass(frozen=True)
class Layout:
    """Where the tables live. Each path has exactly one writer."""

    raw: str
    backfill: str
    curated: str
    hourly: str
    partials: str
    checkpoints: str
    # Without a path, what does not decode is not kept.
    rejects: str = ""

    def __post_init__(self):
        paths = [p.rstrip("/") for p in vars(self).values() if p]
        for path in paths:
            inside = [p for p in paths if p == path or p.startswith(path + "/")]
            if len(inside) > 1:
                raise ValueError(f"every table needs a path of its own: {inside}")

    @classmethod
    def under(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(
            raw=f"{root}/raw",
            backfill=f"{root}/backfill",
            curated=f"{root}/curated",
            hourly=f"{root}/hourly",
            partials=f"{root}/partials",
            checkpoints=f"{root}/checkpoints",
            rejects=f"{root}/rejects",
        )


@dataclass(frozen=True)
class JdbcTarget:
    """A database that gets one table per metric."""

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    table_prefix: str = ""
    # Upper bound on connections that the executors open at the same time.
    connections: int = 16
    batch_size: int = 10_000

    def properties(self) -> dict[str, str]:
        known = {"driver": self.driver, "user": self.user, "password": self.password}
        return {
            **{k: v for k, v in known.items() if v is not None},
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_size),
        }


@dataclass(frozen=True)
class ReportSink:
    """Any Spark format that takes the count reports, such as a search index. Each
    landing adds its rows, unless the mode is another. Formats of files get a folder for
    each batch, which a repeated report replaces; other formats get ``report_id``, the
    same for the same row, to tell connectors that can replace what to replace."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    mode: str = "append"


@dataclass(frozen=True)
class JobConfig:
    layout: Layout
    source: MessageSource | None = None
    metrics: tuple[str, ...] = METRICS
    # Options of the reader that follows the raw table, e.g. maxBytesPerTrigger.
    raw_options: Mapping[str, str] = field(default_factory=dict)
    jdbc: JdbcTarget | None = None
    report: ReportSink | None = None
    # Keep the content of messages that do not decode. The log is read once more for it.
    keep_rejects: bool = True
    # Note offsets that the log no longer had; for sources that skip them silently.
    check_offsets: bool = False
    # How long a run that dies keeps others out.
    lease_seconds: float = 600.0

    def __post_init__(self):
        if not self.metrics:
            raise ValueError("at least one metric is needed")

    def _metrics_key(self) -> str:
        return hashlib.sha256("\n".join(sorted(set(self.metrics))).encode()).hexdigest()[:12]

    @property
    def hourly_checkpoint(self) -> str:
        # The partial averages only hold the configured metrics. Another list
        # therefore gets its own state and is built from the whole raw table.
        return f"{self.layout.checkpoints}/hourly-deltas-{self._metrics_key()}"

    @property
    def partials_path(self) -> str:
        return f"{self.layout.partials}/metrics-{self._metrics_key()}"

    @property
    def changes_path(self) -> str:
        return f"{self.layout.partials}/changes-{self._metrics_key()}"

    @property
    def counts_path(self) -> str:
        return f"{self.layout.partials}/counts"

    @property
    def reported_path(self) -> str:
        return f"{self.layout.partials}/reported"

    @property
    def lease_path(self) -> str:
        return f"{self.layout.checkpoints}/lease"

    @property
    def offsets_path(self) -> str:
        return f"{self.layout.partials}/offsets"

    @property
    def gaps_path(self) -> str:
        return f"{self.layout.partials}/gaps"

    @property
    def live_path(self) -> str:
        return f"{self.layout.partials}/live-{self._metrics_key()}"

    def live_checkpoint(self, part: str) -> str:
        return f"{self.layout.checkpoints}/live-{part}-{self._metrics_key()}"

    @property
    def rejects_checkpoint(self) -> str:
        return f"{self.layout.checkpoints}/rejects"

    @property
    def offsets_checkpoint(self) -> str:
        return f"{self.layout.checkpoints}/offsets"

    @property
    def landing_checkpoint(self) -> str:
        return f"{self.layout.checkpoints}/landing"

    @property
    def curated_checkpoint(self) -> str:
        return f"{self.layout.checkpoints}/curated"

    @classmethod
    def from_spark(cls, spark: SparkSession) -> JobConfig:
        """Read ``spark.wellgauge.*`` from the session the job was submitted with."""
        conf = {
            k.removeprefix(CONF_PREFIX): v
            for k, v in spark.conf.getAll.items()
            if k.startswith(CONF_PREFIX)
        }

        def options(prefix: str) -> dict[str, str]:
            return {k.removeprefix(prefix): v for k, v in conf.items() if k.startswith(prefix)}

        if "root" not in conf:
            raise ValueError(f"set {CONF_PREFIX}root to the folder that holds the tables")
        source = None
        if "source.format" in conf or options("source.option."):
            source = MessageSource(conf.get("source.format", "kafka"), options("source.option."))
        jdbc = None
        if "jdbc.url" in conf:
            jdbc = JdbcTarget(
                url=conf["jdbc.url"],
                driver=conf.get("jdbc.driver"),
                user=conf.get("jdbc.user"),
                password=os.environ.get(PASSWORD_VARIABLE),
                table_prefix=conf.get("jdbc.tablePrefix", ""),
                connections=int(conf.get("jdbc.connections", 16)),
                batch_size=int(conf.get("jdbc.batchSize", 10_000)),
            )
        report = None
        if "report.format" in conf:
            report = ReportSink(
                conf["report.format"],
                options("report.option."),
                conf.get("report.mode", "append"),
            )
        metrics = tuple(m.strip() for m in conf.get("metrics", "").split(",") if m.strip())
        return cls(
            layout=Layout.under(conf["root"]),
            source=source,
            metrics=metrics or METRICS,
            raw_options=options("raw.option."),
            jdbc=jdbc,
            report=report,
            keep_rejects=_is_on(conf.get("rejects.keep", "true")),
            check_offsets=_is_on(conf.get("offsets.check", "false")),
            lease_seconds=float(conf.get("lease.seconds", 600)),
        )


def _is_on(value: str) -> bool:
    if value.lower() not in ("true", "false"):
        raise ValueError(f"neither true nor false: {value}")
    return value.lower() == "true"
