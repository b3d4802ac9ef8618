from wellgauge.plans.batch import backfill, dump_messages, rebuild
from wellgauge.plans.job import enrich, land, publish, publish_all, report, run_job
from wellgauge.plans.lease import Lease, LeaseHeld

__all__ = [
    "Lease",
    "LeaseHeld",
    "backfill",
    "dump_messages",
    "enrich",
    "land",
    "publish",
    "publish_all",
    "rebuild",
    "report",
    "run_job",
]
