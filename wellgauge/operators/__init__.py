from wellgauge.operators.audit import checksums, same_rows
from wellgauge.operators.averages import (
    hour_readings,
    hourly_avg,
    hourly_partials,
    merge_partials,
)
from wellgauge.operators.curate import curate, preview
from wellgauge.operators.decode import (
    as_text,
    decode_envelope,
    decode_nested,
    event_time_parts,
    payload_value,
)
from wellgauge.operators.exact import (
    exact_averages,
    exact_hourly_avg,
    exact_partials,
    merge_exact,
)
from wellgauge.operators.offsets import offset_gaps
from wellgauge.operators.payload_types import payload_schema
from wellgauge.operators.rejects import undecoded
from wellgauge.operators.reports import partition_counts, payload_profile, reject_counts

__all__ = [
    "as_text",
    "checksums",
    "curate",
    "decode_envelope",
    "decode_nested",
    "event_time_parts",
    "exact_averages",
    "exact_hourly_avg",
    "exact_partials",
    "hour_readings",
    "hourly_avg",
    "hourly_partials",
    "merge_exact",
    "merge_partials",
    "offset_gaps",
    "partition_counts",
    "payload_profile",
    "payload_schema",
    "payload_value",
    "preview",
    "reject_counts",
    "same_rows",
    "undecoded",
]
