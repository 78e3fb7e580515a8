"""Daily sales from two streams, receipt headers and receipt lines, that arrive apart and in any order within a delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions import line_amount

DELAY = "1 day"


def lines_of_known_receipts(headers: DataFrame, lines: DataFrame, customers: DataFrame, products: DataFrame, delay: str = DELAY) -> DataFrame:
    """(ts, transaction_id, quantity, line_amount) for each line whose receipt, customer and product are known.

    ``headers`` (transaction_id, ts, customer_id) and ``lines`` (transaction_id, ts, product_id, quantity, unit_price) are streams,
    the other two static. A line's ts may differ from its receipt's by ``delay`` at most. What either side keeps for the other is
    bounded by that and by the watermarks, which trail the newest ts of the slower stream by ``delay``. Null keys meet nothing.
    As in the batch fact all joins are inner and nothing is deduplicated.
    """
    # Watermarks need an instant; with the session zone at UTC it names the same day as the wall clock.
    instant = F.col("ts").cast("timestamp")
    receipts = headers.select("transaction_id", instant.alias("ts"), "customer_id").withWatermark("ts", delay)
    receipts = receipts.join(customers.select("customer_id"), "customer_id")
    sold = lines.select(F.col("transaction_id").alias("receipt_id"), instant.alias("line_ts"), "product_id", "quantity", "unit_price")
    sold = sold.withWatermark("line_ts", delay).join(products.select("product_id"), "product_id")
    span = F.expr(f"INTERVAL {delay}")
    near = (F.col("line_ts") >= F.col("ts") - span) & (F.col("line_ts") <= F.col("ts") + span)
    met = receipts.join(sold, (F.col("transaction_id") == F.col("receipt_id")) & near)
    return met.select("ts", "transaction_id", "quantity", line_amount(F.col("quantity"), F.col("unit_price")).alias("line_amount"))


def closed_days(fact: DataFrame) -> DataFrame:
    """Receipts, units, revenue and average check per day, in append mode: a day comes once, when no more of it can come.

    Lines are added up by receipt within a day and then by day, so receipts are counted exactly and a hot day is spread over all tasks
    until it is closed.
    """
    by_receipt = fact.groupBy(F.window("ts", "1 day"), "transaction_id").agg(F.sum("quantity").alias("items"), F.sum("line_amount").alias("amount"))
    per_day = by_receipt.groupBy(F.window(F.window_time("window"), "1 day")).agg(
        F.count("*").alias("transactions_count"), F.sum("items").cast("bigint").alias("items_sold"), F.sum("amount").alias("revenue")
    )
    return per_day.select(
        F.to_date("window.start").alias("sale_date"), "transactions_count", "items_sold", "revenue", (F.col("revenue") / F.col("transactions_count")).alias("avg_check")
    )
