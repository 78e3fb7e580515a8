"""Silver frames over an order-management star schema stored as Parquet files.

Keys keep the types of the files: bigint keys hash and compare faster than text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmart import schemas

# Receipts longer than this are nested into several documents, as a message has a size limit.
LINES_PER_DOCUMENT = 512


@dataclass(frozen=True)
class Silver:
    customers: DataFrame
    products: DataFrame
    transactions: DataFrame
    items: DataFrame


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def silver(spark: SparkSession, folder: str) -> Silver:
    return Silver(
        customers=customers(spark, folder),
        products=products(spark, folder),
        transactions=transactions(spark, folder),
        items=items(spark, folder),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation")
    customer = read(spark, folder, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("STORE-"), F.col("o_custkey") % 20).alias("store_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


def country_region(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation")
    region = read(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


def receipts(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """POS events with nested items, from flat receipts and lines.

    Receipts without lines have an empty list. A receipt with very many lines is spread over several numbered
    documents of bounded size: lines are counted per receipt, and only the long ones, if any, are split. Document 0
    is always there and stands for the receipt, so its length changes nothing but the number of documents.
    """
    long = (
        items.groupBy("transaction_id")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > LINES_PER_DOCUMENT)
        .withColumn("documents", F.ceil(F.col("n") / LINES_PER_DOCUMENT))
        .drop("n")
    )
    line = F.struct(F.col("product_id").cast("string").alias("product_id"), "quantity", "unit_price")
    nested = (
        items.withColumn("document", F.monotonically_increasing_id())
        .join(long, "transaction_id", "left")
        .withColumn("document", F.pmod(F.xxhash64("document"), F.coalesce("documents", F.lit(1))))
        .groupBy("transaction_id", F.col("document").cast("int").alias("document"))
        .agg(F.collect_list(line).alias("items"))
    )
    # Documents are numbered anew, as none of the lines of a long receipt may have come to some of them.
    order = Window.partitionBy("transaction_id").orderBy("document")
    numbered = nested.withColumn("part", F.row_number().over(order) - 1).drop("document")
    joined = transactions.join(numbered, "transaction_id", "left")
    return _events(joined, F.coalesce("items", _no_items()), F.coalesce("part", F.lit(0)))


def _events(receipts: DataFrame, items: Column, part: Column) -> DataFrame:
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return receipts.select(
        F.concat(F.lit("scheduled__"), F.date_format("ts", "yyyy-MM"), F.lit("-01T00:00:00+00:00")).alias("batch_id"),
        F.col("transaction_id").cast("string").alias("transaction_id"),
        stamp.alias("timestamp"),
        "store_id",
        F.col("customer_id").cast("string").alias("customer_id"),
        items.alias("items"),
        "total_amount",
        "payment_method",
        part.alias("part"),
    )


def _no_items() -> Column:
    return F.array().cast(schemas.POS_EVENT["items"].dataType)
