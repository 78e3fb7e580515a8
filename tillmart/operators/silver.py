"""Raw to Silver: project, type and flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmart import schemas
from tillmart.functions import event_time


def conform(frame: DataFrame, schema: StructType) -> DataFrame:
    """Pick the contract's columns by name and cast them.

    Extra columns are dropped and absent ones become NULL; under ANSI mode a value that does not
    fit its type raises.
    """
    present = set(frame.columns)

    def column(field) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return frame.select([column(field) for field in schema.fields])


def to_customers(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.CUSTOMERS)


def to_products(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.PRODUCTS)


def to_transactions(events: DataFrame) -> DataFrame:
    """One row per receipt, also for receipts without items; of one in several documents the first has the header."""
    events = events.where(F.coalesce("part", F.lit(0)) == 0) if "part" in events.columns else events
    return conform(events.withColumn("ts", event_time(F.col("timestamp"))), schemas.TRANSACTIONS)


def to_items(events: DataFrame) -> DataFrame:
    """One row per receipt line; a receipt without items gives none."""
    lines = events.select("transaction_id", F.explode("items").alias("item"))
    return conform(lines.select("transaction_id", "item.*"), schemas.ITEMS)


def of_batch(events: DataFrame, batch_id: str) -> DataFrame:
    """Events of one batch. An event without a batch id never matches."""
    return events.where(F.col("batch_id") == F.lit(batch_id))
