"""Expressions over receipts and their lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every other character of a batch id becomes "_" in a path.
UNSAFE_BATCH_CHARACTERS = r"[^A-Za-z0-9_.-]"


def _wall_clock_text(text: Column) -> Column:
    without_offset = F.split_part(text, F.lit("+"), F.lit(1))
    return F.replace(F.replace(without_offset, F.lit("Z"), F.lit("")), F.lit("T"), F.lit(" "))


def event_time(text: Column) -> Column:
    """ISO text to TIMESTAMP_NTZ, keeping the wall clock whatever the offset. Bad text raises."""
    return _wall_clock_text(text).cast("timestamp_ntz")


def try_event_time(text: Column) -> Column:
    """Like :func:`event_time`, but bad text becomes NULL."""
    return _wall_clock_text(text).try_cast("timestamp_ntz")


def safe_batch_id(batch_id: Column) -> Column:
    """Batch id as a path segment. Two ids may collide, so the original stays a column."""
    return F.regexp_replace(batch_id, UNSAFE_BATCH_CHARACTERS, "_")


def safe_batch_name(batch_id: str) -> str:
    """The same for an id known to the driver."""
    return re.sub(UNSAFE_BATCH_CHARACTERS, "_", batch_id)


def line_amount(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast("double")


def receipt_total(items: Column) -> Column:
    """Sum of quantity x unit price over a nested item list, in cents precision."""
    total = F.aggregate(items, F.lit(0.0), lambda sum_, item: sum_ + line_amount(item.quantity, item.unit_price))
    return F.round(total, 2)
