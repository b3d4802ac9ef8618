from wellgauge.sources.messages import read_messages, stream_messages
from wellgauge.sources.tables import (
    ensure_hourly,
    of_metric,
    read_backfill,
    read_curated,
    read_hourly,
    read_partials,
    read_raw,
    read_rejects,
    stream_curated,
    stream_raw,
)

__all__ = [
    "ensure_hourly",
    "of_metric",
    "read_backfill",
    "read_curated",
    "read_hourly",
    "read_messages",
    "read_partials",
    "read_raw",
    "read_rejects",
    "stream_curated",
    "stream_messages",
    "stream_raw",
]
