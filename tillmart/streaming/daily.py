"""Daily sales kept up to date by a stream of receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillmart import schemas
from tillmart.functions import event_time, line_amount
from tillmart.streaming.progress import TALLY


def receipt_measures(events: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """(transaction_id, ts, items_sold, revenue, part) from receipts with nested items.

    As in the batch mart, receipts without items do not count; nor, with the static table ``customers``, do those of unknown
    customers. Products are not looked up: a stream of receipts whose products must be known goes through
    Silver and the batch mart.
    """
    if customers is not None:
        events = events.join(customers.select("customer_id").distinct(), "customer_id")
    events = events.where(F.size("items") > 0)
    units = F.aggregate("items", F.lit(0).cast("bigint"), lambda sum_, item: sum_ + item.quantity)
    amount = F.aggregate(
        "items", F.lit(0.0), lambda sum_, item: sum_ + line_amount(item.quantity, item.unit_price)
    )
    return events.select(
        "transaction_id",
        event_time(F.col("timestamp")).alias("ts"),
        units.alias("items_sold"),
        amount.alias("revenue"),
        F.coalesce("part", F.lit(0)).alias("part"),
    )


def daily_sales(receipts: DataFrame, delay: str = "1 day") -> DataFrame:
    """Receipts, units, revenue and average check per day, over a stream of receipts.

    A receipt that comes more than ``delay`` after newer ones is dropped; :func:`late_rows` counts these. A receipt
    delivered again within ``delay`` counts once, so counting receipts replaces the exact distinct
    count. Both states are bounded: keys live for the delay, and closed days leave the aggregate.
    """
    # Watermarks need an instant; with the session zone at UTC it names the same day as the wall clock.
    timed = receipts.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    # a receipt in several documents counts with its first one
    parts = ["part"] if "part" in receipts.columns else []
    first = F.count_if(F.col("part") == 0) if parts else F.count("*")
    once = timed.dropDuplicatesWithinWatermark(["transaction_id", *parts])
    per_day = once.groupBy(F.window("ts", "1 day")).agg(
        first.alias("transactions_count"),
        F.sum("items_sold").cast("bigint").alias("items_sold"),
        F.sum("revenue").alias("revenue"),
    )
    return per_day.select(
        F.to_date("window.start").alias("sale_date"),
        "transactions_count",
        "items_sold",
        "revenue",
        (F.col("revenue") / F.col("transactions_count")).alias("avg_check"),
    )


def maintain(daily: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Write each day that a micro-batch touched, or in append mode closed, replacing that day's partition, then stop.

    A day arrives with its full value in either mode, so a repeated micro-batch changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("sale_date")
            .parquet(path)
        )

    TALLY.listen(daily.sparkSession)
    return (
        daily.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that the finished query dropped, in any micro-batch, because they came later than the watermark allows."""
    return TALLY.finished(query).late


def require_none_late(query: StreamingQuery) -> None:
    """Refuse to go on with days that miss late receipts; a longer delay or the batch mart has them."""
    if late := late_rows(query):
        raise ValueError(f"{late} rows came later than the watermark allows and are not in the daily sales.")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SALES_DAILY).parquet(path).select(*schemas.SALES_DAILY.fieldNames())
