from wellgauge.sinks.database import write_metrics
from wellgauge.sinks.report import write_report
from wellgauge.sinks.tables import (
    append_table,
    overwrite_table,
    write_hourly,
    write_partials,
    write_touched,
)

__all__ = [
    "append_table",
    "overwrite_table",
    "write_hourly",
    "write_metrics",
    "write_partials",
    "write_report",
    "write_touched",
]
