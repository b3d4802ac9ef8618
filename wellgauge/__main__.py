"""``spark-submit`` entry: one stage per call, or the whole job.

Stages read their settings from ``spark.wellgauge.*``; see the README.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wellgauge.config import JobConfig
from wellgauge.operators.curate import preview
from wellgauge.plans import backfill, enrich, land, publish, publish_all, report, run_job
from wellgauge.plans.lease import Lease
from wellgauge.session import job_session
from wellgauge.sources import read_curated, read_messages


def _backfill(spark: SparkSession, config: JobConfig) -> None:
    if config.source is None:
        raise ValueError("a backfill needs a message source")
    backfill(read_messages(spark, config.source), config.layout.backfill)


def _preview(spark: SparkSession, config: JobConfig) -> None:
    preview(read_curated(spark, config.layout.curated)).show(truncate=False)


STAGES = {
    "land": land,
    "enrich": enrich,
    "publish": publish,
    "publish-all": publish_all,
    "report": report,
    "run": run_job,
    "backfill": _backfill,
    "preview": _preview,
}


# Stages that write what a whole run writes too, and take the lease a run takes itself.
ALONE = ("land", "enrich", "publish", "publish-all", "report")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wellgauge", description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    stage = parser.parse_args(arguments).stage
    spark = job_session(SparkSession.builder.appName(f"wellgauge-{stage}").getOrCreate())
    try:
        config = JobConfig.from_spark(spark)
        if stage in ALONE:
            with Lease(spark, config.lease_path, config.lease_seconds):
                STAGES[stage](spark, config)
        else:
            STAGES[stage](spark, config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
