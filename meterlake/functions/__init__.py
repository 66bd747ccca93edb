"""Scalar column functions: time buckets, partition labels, bands, formats."""

from meterlake.functions.format import (
    grouped_number, human_bytes, pct_change, savings_pct, sorted_report, speedup,
)
from meterlake.functions.time import (
    BUCKET_ORIGIN, EPOCH, as_ntz, chunk_label, day_label, floor_to, hour_of,
    label_of, parse_label, period_type, time_bucket, to_utc, width_micros,
)

__all__ = [
    "BUCKET_ORIGIN", "EPOCH", "as_ntz", "chunk_label", "day_label", "floor_to",
    "grouped_number", "hour_of", "human_bytes", "label_of", "parse_label", "pct_change",
    "period_type", "savings_pct", "sorted_report", "speedup", "time_bucket", "to_utc",
    "width_micros",
]
