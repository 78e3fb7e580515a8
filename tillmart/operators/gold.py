"""Silver to Gold: the line-level fact and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions import day, line_amount


def fact_sales(
    transactions: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per receipt line whose receipt, customer and product are all known.

    All joins are inner, and duplicate customers or products fan out. Each dimension joins the narrow side
    it belongs to before receipts meet their lines: if a dimension is too large to broadcast, four-column
    lines are shuffled by product rather than the wide fact, and the result stays partitioned by
    transaction, which the distinct count in :func:`sales_daily` reuses. No join hint is given: Spark
    broadcasts what it measures to be small, and splits hot keys of the shuffled joins.
    """
    receipts = transactions.select(
        "transaction_id", "ts", "store_id", "customer_id", "payment_method"
    ).join(customers.select("customer_id", "first_name", "last_name", "city", "segment"), "customer_id")
    lines = items.select("transaction_id", "product_id", "quantity", "unit_price").join(
        products.select("product_id", F.col("name").alias("product_name"), "category", "brand"), "product_id"
    )
    return receipts.join(lines, "transaction_id").select(
        "transaction_id", "ts", "store_id",
        "customer_id", "first_name", "last_name", "city", "segment",
        "product_id", "product_name", "category", "brand",
        "quantity", "unit_price",
        line_amount(F.col("quantity"), F.col("unit_price")).alias("line_amount"),
        "payment_method",
    )


def sales_daily(fact: DataFrame) -> DataFrame:
    """Receipts, units, revenue and average check per day.

    Spark first groups by (day, transaction) and then by day, each with map-side combining, so a day or
    a receipt that holds a large share of the lines is spread over all tasks.
    """
    receipts = F.count_distinct("transaction_id")
    revenue = F.sum("line_amount")
    return fact.groupBy(day(F.col("ts")).alias("sale_date")).agg(
        receipts.alias("transactions_count"),
        F.sum("quantity").cast("bigint").alias("items_sold"),
        revenue.alias("revenue"),
        (revenue / receipts).alias("avg_check"),
    )


def product_sales(fact: DataFrame) -> DataFrame:
    """Units and revenue per product."""
    return fact.groupBy("product_id", "product_name", "category", "brand").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum("line_amount").alias("revenue"),
    )


def revenue_by_day(fact: DataFrame, *series: str) -> DataFrame:
    """Daily revenue per series, the input of the panel forecast."""
    return fact.groupBy(*series, day(F.col("ts")).alias("sale_date")).agg(F.sum("line_amount").alias("revenue"))


def with_region(customers: DataFrame, lookup: DataFrame) -> DataFrame:
    """Customers with the region of their country, the lookup living in another database."""
    return customers.join(lookup, "country").select("name", "country", "region")


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new`` whose key is not in ``existing``, one per key; a NULL key raises.

    When a key repeats within ``new`` the smallest row wins, so reruns agree. The minimum combines
    map-side and leaves unique keys for the anti join.
    """
    values = [column for column in new.columns if column not in keys]
    # Part of the key rather than a filter, which Spark would also apply to the other side of the join.
    error = F.raise_error(F.lit("NULL in a primary key"))
    checked = new.withColumns({key: F.coalesce(key, error) for key in keys})
    if values:
        smallest = checked.groupBy(*keys).agg(F.min(F.struct(*values)).alias("row"))
        unique = smallest.select(*keys, "row.*")
    else:
        unique = checked.distinct()
    # The other side is reduced as well: the right side of an anti join is not split where a key is hot.
    return unique.join(existing.select(*keys).distinct(), keys, "left_anti").select(*new.columns)
