"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    return F.to_date(ts)


def time_grain(column: Column, grain: str = "day") -> Column:
    """Start of the day, week, month, quarter or year a date falls in."""
    if grain == "day":
        return F.to_date(column)
    return F.trunc(F.to_date(column), grain)


def in_range(column: Column, start=None, end=None) -> Column:
    """``start <= column < end``; a missing bound is open, no bounds means no filter."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (column >= F.lit(start))
    if end is not None:
        condition = condition & (column < F.lit(end))
    return condition


def calendar_features(date: Column) -> dict[str, Column]:
    """Day of week with Monday as 0, and a weekend flag."""
    return {"dow": F.weekday(date), "is_weekend": F.weekday(date).isin(5, 6).cast("int")}
