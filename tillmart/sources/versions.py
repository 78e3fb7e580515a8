"""Point-in-time reads over versioned rows.

Rows carry the version that added them: its number, its time, and whether it appended to the table or replaced it. A
dataset partitioned by these columns is pruned to the versions that a read needs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

APPEND, REPLACE = "append", "replace"
VERSION_COLUMNS = ("snapshot_id", "committed_at", "operation")


def as_of(versions: DataFrame, moment: datetime) -> DataFrame:
    """The table as it was at ``moment``; raises when there was no version yet."""
    committed = versions.where(F.col("committed_at") <= _timestamp(moment))
    nothing = F.raise_error(F.lit(f"No version at or before {moment}")).cast("bigint")
    bounds = committed.agg(
        F.coalesce(F.max("snapshot_id"), nothing).alias("last"),
        F.coalesce(
            F.max(F.when(F.col("operation") == REPLACE, F.col("snapshot_id"))), F.min("snapshot_id"), nothing
        ).alias("first"),
    )
    in_version = F.col("snapshot_id").between(bounds.select("first").scalar(), bounds.select("last").scalar())
    return versions.where(in_version).drop(*VERSION_COLUMNS)


def _timestamp(moment: datetime) -> Column:
    return F.lit(f"{moment:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz")
