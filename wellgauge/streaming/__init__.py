from wellgauge.streaming.audit import read_gaps, start_offset_audit, start_rejects
from wellgauge.streaming.control import AVAILABLE_NOW, await_all, every, run_for, start_all
from wellgauge.streaming.counts import CountBook, count_uncounted, observe_counts
from wellgauge.streaming.curated import start_curated
from wellgauge.streaming.hourly import refresh_hours, start_hourly, write_pending_hours
from wellgauge.streaming.landing import start_console, start_landing
from wellgauge.streaming.live import late_readings, read_live, start_live
from wellgauge.streaming.reporting import (
    READ_REPORT,
    REJECT_REPORT,
    WRITE_REPORT,
    report_stage,
)

__all__ = [
    "AVAILABLE_NOW",
    "CountBook",
    "READ_REPORT",
    "REJECT_REPORT",
    "WRITE_REPORT",
    "await_all",
    "count_uncounted",
    "every",
    "late_readings",
    "observe_counts",
    "read_gaps",
    "read_live",
    "refresh_hours",
    "report_stage",
    "run_for",
    "start_all",
    "start_console",
    "start_curated",
    "start_hourly",
    "start_landing",
    "start_live",
    "start_offset_audit",
    "start_rejects",
    "write_pending_hours",
]
