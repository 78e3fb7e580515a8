"""Column expressions. All of them stay inside generated code."""

from tillmart.functions.events import (
    event_time,
    line_amount,
    receipt_total,
    safe_batch_id,
    safe_batch_name,
    try_event_time,
)
from tillmart.functions.time import calendar_features, day, in_range, time_grain

__all__ = [
    "calendar_features",
    "day",
    "event_time",
    "in_range",
    "line_amount",
    "receipt_total",
    "safe_batch_id",
    "safe_batch_name",
    "time_grain",
    "try_event_time",
]
