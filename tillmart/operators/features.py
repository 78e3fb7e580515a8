"""Lag and rolling-mean features over daily revenue, for any number of series at once.

A series has at most one row per calendar day, so a window partition is bounded by the calendar however
many receipts stand behind it. Every function here needs the same partitioning and order, so a chain of
them costs one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.functions import calendar_features

# Fixed values of the feature set and of the history gates.
LAGS = (1, 2, 7)
ROLLING = (3, 7)
FEATURES = (
    "dow", "is_weekend",
    "revenue_lag_1", "revenue_lag_2", "revenue_lag_7",
    "revenue_rolling_3", "revenue_rolling_7",
)
MIN_HISTORY_ROWS = 14
MIN_FEATURE_ROWS = 3
# What a row must have to be trained on; the name of its series may be NULL.
NEEDED = ("sale_date", "revenue", *FEATURES)
STATE_LENGTH = max(*LAGS, *ROLLING)


def with_features(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """All rows with the seven features; those without enough history hold NULLs.

    Lags count rows, not calendar days. A rolling mean looks at the k rows before the current one and
    needs all of them to be non-null.
    """
    ordered = Window.partitionBy(*series).orderBy("sale_date")

    def rolling(size: int) -> Column:
        frame = ordered.rowsBetween(-size, -1)
        return F.when(F.count("revenue").over(frame) == size, F.avg("revenue").over(frame))

    columns = calendar_features(F.col("sale_date"))
    columns |= {f"revenue_lag_{k}": F.lag("revenue", k).over(ordered) for k in LAGS}
    columns |= {f"revenue_rolling_{k}": rolling(k) for k in ROLLING}
    return daily.withColumns(columns)


def features(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """The rows on which a model can be trained: those without any NULL."""
    return with_features(daily, series).dropna(subset=list(NEEDED))


def is_complete() -> Column:
    return reduce(and_, [F.col(column).isNotNull() for column in NEEDED])


def history_gate(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Per series: is there enough history, and how many rows decided it."""
    framed = with_features(daily, series)
    counted = framed.groupBy(*series).agg(
        F.count("*").alias("history"),
        F.count_if(is_complete()).alias("usable"),
    )
    short = F.col("history") < MIN_HISTORY_ROWS
    return counted.select(
        *series,
        F.when(short, F.col("history")).otherwise(F.col("usable")).alias("rows_available"),
        (short | (F.col("usable") < MIN_FEATURE_ROWS)).alias("skipped"),
    )


def split(frame: DataFrame, series: Sequence[str] = (), fraction: float | None = None) -> DataFrame:
    """Mark the newest rows of each series as holdout: the last row, or the last ``fraction`` of them."""
    partition = Window.partitionBy(*series)
    position = F.row_number().over(partition.orderBy("sale_date"))
    rows = F.count("*").over(partition)
    train_rows = rows - 1 if fraction is None else F.floor(rows * F.lit(1.0 - fraction))
    return frame.withColumn("is_holdout", position > train_rows)


def last_values(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Per series: the last date and the last seven revenues, oldest first."""
    newest_first = Window.partitionBy(*series).orderBy(F.desc("sale_date"))
    recent = daily.withColumn("age", F.row_number().over(newest_first)).where(F.col("age") <= STATE_LENGTH)
    pairs = F.sort_array(F.collect_list(F.struct("sale_date", "revenue")))
    return recent.groupBy(*series).agg(
        F.max("sale_date").alias("last_date"),
        F.transform(pairs, lambda pair: pair.revenue).alias("recent"),
    )


def next_features(last_date: Column, recent: Column) -> dict[str, Column]:
    """The features of the day after ``last_date``, read from the last seven revenues."""
    columns = calendar_features(F.date_add(last_date, 1))
    columns |= {f"revenue_lag_{k}": F.element_at(recent, -k) for k in LAGS}
    columns |= {f"revenue_rolling_{k}": _mean_of_last(recent, k) for k in ROLLING}
    return columns


def _mean_of_last(recent: Column, size: int) -> Column:
    return F.aggregate(F.slice(recent, -size, size), F.lit(0.0), lambda sum_, value: sum_ + value) / size


def mean_absolute_error(predictions: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Error of the ``prediction`` column against ``revenue``, per series."""
    error = F.avg(F.abs(F.col("revenue") - F.col("prediction")))
    return predictions.groupBy(*series).agg(error.alias("mae"))


def rank_candidates(scores: DataFrame, series: Sequence[str], preference: Sequence[str]) -> DataFrame:
    """Rank the scored candidates of each series, the lowest error first; ties go by ``preference``."""
    order = F.array_position(F.array(*[F.lit(name) for name in preference]), F.col("model_name"))
    ranking = Window.partitionBy(*series).orderBy("mae", order)
    return scores.select(*series, "model_name", "mae", F.row_number().over(ranking).alias("rank"))
