"""Fact, marts, region join and insert-if-absent."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests import rows
from tillmart import schemas
from tillmart.operators import gold, quality
from tillmart.plans import reports


@pytest.fixture(scope="module")
def fact(spark):
    return gold.fact_sales(*rows.silver(spark)).cache()


def test_fact_has_the_contract_and_drops_orphans(fact):
    assert fact.schema.simpleString() == schemas.FACT_SALES.simpleString()
    found = sorted((row.transaction_id, row.product_id, row.line_amount) for row in fact.collect())
    assert found == [("t1", "p1", 200.0), ("t1", "p2", 50.0), ("t2", "p3", 10.0), ("t5", "p3", 30.0)]


def test_duplicate_products_fan_out(spark):
    doubled = gold.fact_sales(*rows.silver(spark, products=[*rows.PRODUCTS, rows.PRODUCTS[2]]))
    assert doubled.count() == 6


def test_sales_daily(fact):
    daily = gold.sales_daily(fact)
    assert daily.schema.simpleString() == schemas.SALES_DAILY.simpleString()
    assert [tuple(row) for row in daily.orderBy("sale_date").collect()] == [
        (dt.date(2026, 7, 4), 2, 4, 260.0, 130.0),
        (dt.date(2026, 7, 5), 1, 3, 30.0, 30.0),
    ]


def test_invariants(fact):
    daily, products = gold.sales_daily(fact), gold.product_sales(fact)
    assert products.schema.simpleString() == schemas.PRODUCT_SALES.simpleString()
    revenue = [frame.agg(F.sum(name)).first()[0] for frame, name in
               ((fact, "line_amount"), (daily, "revenue"), (products, "revenue"))]
    assert revenue == [290.0] * 3
    assert daily.agg(F.sum("items_sold")).first()[0] == products.agg(F.sum("units_sold")).first()[0] == 7


def test_products_with_one_name_merge_in_the_top_list(fact):
    products = gold.product_sales(fact)
    assert products.count() == 3
    top = [tuple(row) for row in reports.top_products(products).collect()]
    assert top == [("Чайник", 250.0), ("Лампа", 40.0)]


def test_average_check_is_the_mean_of_the_days(fact):
    daily = gold.sales_daily(fact)
    assert reports.kpi_avg_check(daily).first()[0] == 80.0
    assert reports.kpi_transactions(daily).first()[0] == 3


def test_trend_range_is_half_open(fact):
    daily = gold.sales_daily(fact)
    assert reports.trend_revenue(daily).count() == 2
    one = reports.trend_revenue(daily, time_range=("2026-07-04", "2026-07-05")).collect()
    assert [tuple(row) for row in one] == [(dt.date(2026, 7, 4), 260.0)]
    assert reports.trend_revenue(daily, grain="month").first().revenue == 290.0


SAMPLE = [(1, "Alice", "DE"), (2, "Bob", "NL"), (3, "Carlos", "ES"), (4, "Diana", "FR")]
REGIONS = [(country, "Europe") for country in ("DE", "NL", "ES", "FR")]


def test_region_join(spark):
    customers = spark.createDataFrame(SAMPLE, schemas.LAKE_CUSTOMERS)
    lookup = spark.createDataFrame(REGIONS, schemas.COUNTRY_REGION)
    found = {tuple(row) for row in gold.with_region(customers, lookup).collect()}
    assert found == {(name, country, "Europe") for _, name, country in SAMPLE}


def test_insert_if_absent_keeps_first_values(spark):
    none = spark.createDataFrame([], schemas.COUNTRY_REGION)
    new = spark.createDataFrame(REGIONS, schemas.COUNTRY_REGION)
    first = none.unionByName(gold.insert_if_absent(none, new, ["country"]))
    changed = new.withColumn("region", F.lit("Elsewhere"))
    second = first.unionByName(gold.insert_if_absent(first, changed, ["country"]))
    assert {tuple(row) for row in second.collect()} == set(REGIONS)
    assert second.count() == 4


def test_insert_if_absent_repeated_and_null_keys(spark):
    none = spark.createDataFrame([], schemas.COUNTRY_REGION)
    new = spark.createDataFrame([("PL", "b"), ("PL", "a"), ("PL", "c")], schemas.COUNTRY_REGION)
    assert [tuple(row) for row in gold.insert_if_absent(none, new, ["country"]).collect()] == [("PL", "a")]
    assert gold.insert_if_absent(none, new.select("country"), ["country"]).count() == 1
    with pytest.raises(Exception, match="NULL in a primary key"):
        nulls = spark.createDataFrame([(None, "x")], schemas.COUNTRY_REGION)
        gold.insert_if_absent(none, nulls, ["country"]).collect()


def test_insert_if_absent_ignores_null_keys_that_exist(spark):
    existing = spark.createDataFrame([(None, "x"), ("DE", "y")], schemas.COUNTRY_REGION)
    new = spark.createDataFrame(REGIONS, schemas.COUNTRY_REGION)
    assert gold.insert_if_absent(existing, new, ["country"]).count() == 3


def test_hot_keys_are_split(spark, tmp_path):
    """With broadcasts off, a customer and a product holding most rows are split over several tasks."""
    hot = spark.range(200_000).select(
        F.col("id").alias("transaction_id"),
        F.lit(dt.datetime(2026, 7, 4)).cast("timestamp_ntz").alias("ts"),
        F.lit("s").alias("store_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("customer_id"),
        F.lit("card").alias("payment_method"),
    )
    items = spark.range(200_000).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(1.0).alias("unit_price"),
    )
    people = spark.range(1000).selectExpr("id customer_id", "'a' first_name", "'b' last_name", "'c' city", "'d' segment")
    goods = spark.range(1000).selectExpr("id product_id", "'n' name", "'k' category", "'b' brand")
    hot.repartition(8).write.parquet(f"{tmp_path}/t")
    items.repartition(8).write.parquet(f"{tmp_path}/i")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = gold.fact_sales(spark.read.parquet(f"{tmp_path}/t"), people, spark.read.parquet(f"{tmp_path}/i"), goods)
        daily = gold.sales_daily(fact)
        assert daily.collect()[0].transactions_count == 200_000
        plan = daily._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin(skew=true)") >= 2
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_orphans(spark):
    report = quality.orphan_report(*rows.silver(spark))
    assert {row.reason: row.row_count for row in report.collect()} == {
        "transaction with unknown customer": 1,
        "item with unknown product": 1,
        "transaction without items": 1,
        "item without transaction": 1,
    }


def test_counts_join_the_fact_once(spark):
    """The marts and the counts read the fact that was written; the plan left has no join."""
    from tillmart.plans.queries import QUERIES

    plan = QUERIES["gold_row_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 7 and "Join" not in plan


def test_hot_keys_of_existing_rows_are_reduced(spark):
    existing = spark.range(1000).selectExpr("id % 2 AS key", "'old' AS value")
    new = spark.range(4).selectExpr("id AS key", "'new' AS value")
    found = gold.insert_if_absent(existing, new, ["key"])
    assert sorted(row.key for row in found.collect()) == [2, 3]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
