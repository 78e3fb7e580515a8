"""Every operator as a query over the star schema; :mod:`tillmart.plans.oracle` has the SQL of each.

Sums of doubles depend on the order of addition, so revenue is compared in cents, and ratios are taken of the
rounded sums.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.functions import event_time, receipt_total, safe_batch_id
from tillmart.operators import features, gold, least_squares, quality, silver
from tillmart.plans import forecast, incremental, pipeline, reports
from tillmart.session import brief_shuffles, checkpoint_root, scratch_path, tune
from tillmart.sources import json_arrays, json_files, messages, star_schema, tables, versions
from tillmart.streaming import daily as daily_stream
from tillmart.streaming import fact as fact_stream
from tillmart.streaming import ingest as ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2000, 7, 1)
RANGE = ("1997-01-01", "1998-01-01")
BATCH_DAY = "2024-01-15"
TREND_ROWS = 10000
BOUNDED_BATCH = "scheduled__1997-05-01T00:00:00+00:00"


def _kept(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again; its size is then known to the planner."""
    path = scratch_path(spark, name)
    with brief_shuffles(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# Marts ----------------------------------------------------------------------
def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    s = star_schema.silver(spark, folder)
    return gold.fact_sales(s.transactions, s.customers, s.items, s.products)


def sales_daily(spark: SparkSession, folder: str) -> DataFrame:
    revenue = F.round("revenue", 2)
    return gold.sales_daily(fact_sales(spark, folder)).withColumns(
        {"revenue": revenue, "avg_check": revenue / F.col("transactions_count")}
    )


def product_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.product_sales(fact_sales(spark, folder)).withColumn("revenue", F.round("revenue", 2))


def federated_region(spark: SparkSession, folder: str) -> DataFrame:
    customers = star_schema.customers(spark, folder).select(
        F.concat_ws("#", "first_name", "last_name").alias("name"), F.col("city").alias("country")
    )
    lookup = _kept(spark, star_schema.country_region(spark, folder), "lookup")
    return gold.with_region(customers, lookup)


# Reports --------------------------------------------------------------------
def kpi_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpi_revenue(sales_daily(spark, folder)).withColumn("revenue", F.round("revenue", 2))


def kpi_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpi_transactions(sales_daily(spark, folder))


def kpi_avg_check(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpi_avg_check(sales_daily(spark, folder)).withColumn("avg_check", F.round("avg_check", 4))


def trend_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.trend_revenue(sales_daily(spark, folder))


def trend_revenue_limited(spark: SparkSession, folder: str) -> DataFrame:
    """As a chart with a row limit shows it: the oldest days up to the limit."""
    return reports.trend_revenue(sales_daily(spark, folder), limit=TREND_ROWS)


def trend_revenue_range(spark: SparkSession, folder: str) -> DataFrame:
    return reports.trend_revenue(sales_daily(spark, folder), time_range=RANGE)


def trend_revenue_monthly(spark: SparkSession, folder: str) -> DataFrame:
    monthly = reports.trend_revenue(sales_daily(spark, folder), grain="month")
    return monthly.withColumn("revenue", F.round("revenue", 2))


def trend_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.trend_transactions(sales_daily(spark, folder))


def top10_products(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_products(product_sales(spark, folder)).withColumn("revenue", F.round("revenue", 2))


# Silver ---------------------------------------------------------------------
def _raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    return star_schema.customers(spark, folder).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "first_name", "last_name", "city", "segment",
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("customer_id") % 2000).cast("int"))
        .cast("string").alias("registration_date"),
        F.lit("2026-07-01").alias("ingestion_batch_date"),
    )


def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot rows without an email, as JSON text, read back leniently and typed."""
    return silver.to_customers(_through_json(_raw_customers(spark, folder), schemas.RAW_CUSTOMER))


def _raw_products(spark: SparkSession, folder: str) -> DataFrame:
    return star_schema.products(spark, folder).select(
        F.col("product_id").cast("string").alias("product_id"),
        "name", "category", "brand", "price", F.lit("RUB").alias("currency"),
    )


def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return silver.to_products(_through_json(_raw_products(spark, folder), schemas.RAW_PRODUCT))


def _through_json(raw: DataFrame, schema) -> DataFrame:
    return messages.encode(raw).select(F.from_json("value", schema).alias("row")).select("row.*")


def _receipts(spark: SparkSession, folder: str) -> DataFrame:
    return star_schema.receipts(star_schema.transactions(spark, folder), star_schema.items(spark, folder))


def silver_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Whole receipts as messages: each gives its header, with or without lines."""
    nested = messages.encode(_receipts(spark, folder))
    return silver.to_transactions(messages.strict(messages.decode(nested)))


def silver_items_flatten(spark: SparkSession, folder: str) -> DataFrame:
    nested = messages.encode(_receipts(spark, folder))
    return silver.to_items(messages.strict(messages.decode(nested)))


def receipt_total_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    transactions = star_schema.transactions(spark, folder).withColumn(
        "transaction_id", F.col("transaction_id").cast("string")
    )
    documents = _receipts(spark, folder).where(F.size("items") > 0)
    totals = documents.select("transaction_id", receipt_total(F.col("items")).alias("receipt_total"))
    return quality.reconcile(transactions, totals)


def timestamp_normalize(spark: SparkSession, folder: str) -> DataFrame:
    offsets = F.array(*[F.lit(text) for text in ("Z", "+03:00", "-05:00", "")])
    text = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.element_at(offsets, (F.col("event_id") % 4 + 1).cast("int")),
    )
    return star_schema.read(spark, folder, "events").select("event_id", event_time(text).alias("ts"))


def _events_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    return star_schema.read(spark, folder, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        "event_type",
        "value",
    )


def batch_id_sanitize(spark: SparkSession, folder: str) -> DataFrame:
    batch_id = F.concat(
        F.lit("scheduled__"), F.date_format("ts", "yyyy-MM-dd"), F.lit("T"), F.col("user_id"), F.lit(":00+00:00")
    )
    return star_schema.read(spark, folder, "events").select(
        "event_id", batch_id.alias("batch_id"), safe_batch_id(batch_id).alias("batch_key")
    )


def batch_filter(spark: SparkSession, folder: str) -> DataFrame:
    """From events stored by batch, as Raw is: only the wanted batch is read."""
    path, events = scratch_path(spark, "batches"), _events_in_batches(spark, folder)
    # gathers small batches into one file each and splits large ones, instead of one file for each task and batch
    events.hint("rebalance", "batch_id").write.partitionBy("batch_id").parquet(path)
    stored = spark.read.schema(events.schema).parquet(path).select(*events.columns)
    return silver.of_batch(stored, BATCH_DAY)


def batch_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """All days as batches; the busiest ones were announced with one event more than arrived."""
    events = _events_in_batches(spark, folder)
    counted = events.groupBy("batch_id").agg(F.count("*").alias("n"))
    busiest = counted.agg(F.max("n").alias("most"))
    announced = counted.select(
        "batch_id", F.when(F.col("n") == busiest.scalar(), F.col("n") + 1).otherwise(F.col("n")).alias("expected")
    )
    return quality.check_batches(events, announced).select("batch_id", "expected", "received", "passed")


def event_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    # JSON's own time format has milliseconds
    events = star_schema.read(spark, folder, "events").withColumn("ts", F.col("ts").cast("string"))
    parsed = messages.encode(events).select(F.from_json("value", schema).alias("e")).select("e.*")
    return parsed.select(
        "event_id", "ts", "user_id", "event_type", "value", F.from_json("props", "k BIGINT")["k"].alias("k")
    )


# Quality --------------------------------------------------------------------
def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    s = star_schema.silver(spark, folder)
    # The fact is joined once; the marts and the counts read what was written.
    fact = _kept(spark, gold.fact_sales(s.transactions, s.customers, s.items, s.products), "fact")
    return {
        "silver_transactions": s.transactions,
        "silver_items": s.items,
        "fact_sales": fact,
        "sales_daily": gold.sales_daily(fact),
        "product_sales": gold.product_sales(fact),
    }


def gold_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_counts(_tables(spark, folder))


def gold_validation(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validate_gold(gold_row_counts(spark, folder)).select("check", "passed")


def orphan_report(spark: SparkSession, folder: str) -> DataFrame:
    """Against a snapshot of the customers in credit and the products up to size 45."""
    s = star_schema.silver(spark, folder)
    in_credit = star_schema.read(spark, folder, "customer").where("c_acctbal >= 0")
    small = star_schema.read(spark, folder, "part").where("p_size <= 45")
    return quality.orphan_report(
        s.transactions,
        in_credit.select(F.col("c_custkey").alias("customer_id")),
        s.items,
        small.select(F.col("p_partkey").alias("product_id")),
    )


# Tables and versions --------------------------------------------------------
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """The customers seen in receipts, completed from the customer snapshot."""
    transactions = star_schema.transactions(spark, folder)
    existing = transactions.select("customer_id", F.lit("SEEN").alias("segment"))
    snapshot = star_schema.customers(spark, folder).select("customer_id", "segment")
    return existing.distinct().unionByName(gold.insert_if_absent(existing, snapshot, ["customer_id"]))


def _versioned_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders committed year by year, each year on the next New Year's Day."""
    year = F.year("o_orderdate")
    return star_schema.read(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        year.cast("bigint").alias("snapshot_id"),
        F.concat(year + 1, F.lit("-01-01 00:00:00")).cast("timestamp_ntz").alias("committed_at"),
        F.lit(versions.APPEND).alias("operation"),
    )


def as_of_read(spark: SparkSession, folder: str) -> DataFrame:
    return versions.as_of(_versioned_orders(spark, folder), AS_OF)


def table_refresh_append(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table refreshed twice with the finished orders, then appended with all others."""
    location = scratch_path(spark, "lake")
    database = "tillmart_" + location[-12:]
    tables.ensure_tables(spark, database, schemas.SAMPLE_TABLES, location)
    orders = star_schema.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
        "o_orderstatus",
    )
    table = f"{database}.orders"
    for _ in range(2):
        tables.refresh(orders.where("o_orderstatus = 'F'"), table)
    tables.append(orders.where("o_orderstatus <> 'F'"), table)
    result = _kept(spark, tables.scan(spark, table), "lake-orders")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


def _marts(spark: SparkSession) -> incremental.Marts:
    location = scratch_path(spark, "marts")
    return incremental.Marts("tillmart_" + location[-12:], location)


def incremental_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Both marts after three batches, of which the second came incomplete and with foreign receipts before, and was delivered again."""
    s, marts = star_schema.silver(spark, folder), _marts(spark)
    number, early = F.col("transaction_id") % 3, F.col("ts") < F.lit("1998-01-01").cast("timestamp_ntz")
    batches = [("run:0", number == 0, True), ("run:1", number >= 1, early), ("run:1", number == 1, True), ("run:2", number == 2, True)]
    for name, chosen, sent in batches:
        # a batch brings the lines of its receipts, not those of all others
        transactions, items = s.transactions.where(chosen & sent), s.items.where(chosen)
        incremental.apply_batch(spark, marts, name, transactions, s.customers, items, s.products)
    days = spark.table(marts.table("sales_daily"))
    goods = spark.table(marts.table("product_sales"))
    rows = days.select(
        F.lit("day").alias("mart"), F.col("sale_date").cast("string").alias("label"), F.col("transactions_count").alias("receipts"),
        F.col("items_sold").alias("units"), F.round("revenue", 2).alias("revenue"),
    ).unionByName(goods.select(
        F.lit("product").alias("mart"), F.col("product_id").alias("label"), F.lit(None).cast("bigint").alias("receipts"),
        F.col("units_sold").alias("units"), F.round("revenue", 2).alias("revenue"),
    ))
    result = _kept(spark, rows, "marts-rows")
    spark.sql(f"DROP DATABASE {marts.database} CASCADE")
    return result


def fact_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue on the order days of one quarter, from the fact stored by month: the joined calendar prunes the other months."""
    s, marts = star_schema.silver(spark, folder), _marts(spark)
    incremental.apply_batch(spark, marts, "all", s.transactions, s.customers, s.items, s.products)
    days = s.transactions.select(F.to_date("ts").alias("sale_date")).where("year(sale_date) = 1997 and quarter(sale_date) = 2")
    revenue = F.round(F.sum("line_amount"), 2).alias("revenue")
    result = incremental.of_calendar(spark, marts, days).groupBy("sale_date").agg(F.count("*").alias("lines"), revenue)
    result = _kept(spark, result, "calendar-days")
    spark.sql(f"DROP DATABASE {marts.database} CASCADE")
    return result


def raw_batch_files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole receipts written below their batch, written again, read back, and flattened with their headers."""
    path = scratch_path(spark, "raw")
    receipts = _kept(spark, _receipts(spark, folder), "receipts")
    for _ in range(2):
        json_files.write_raw_batches(receipts, path)
    return _flat(json_files.read_snapshot(spark, path, schemas.POS_EVENT))


def raw_array_files(spark: SparkSession, folder: str) -> DataFrame:
    """Whole receipts stored as JSON arrays, one file for each batch, and read back by the array reader."""
    path = scratch_path(spark, "raw-arrays")
    receipts = _kept(spark, _receipts(spark, folder), "receipts")
    text = F.to_json(F.struct(*schemas.POS_EVENT.fieldNames()), {"ignoreNullFields": "false"})
    json_arrays.write(receipts.select("batch_id", text.alias("value")), path, "batch_id")
    documents = json_files.read_documents(spark, path, json_files.ARRAY, json_arrays.WRITTEN)
    return _flat(messages.strict(messages.decode(documents)))


def _flat(events: DataFrame) -> DataFrame:
    lines = events.select(*[c for c in events.columns if c not in ("items", "part")], F.explode_outer("items").alias("item"))
    return lines.select(*[c for c in lines.columns if c != "item"], "item.*")


def _chain(spark: SparkSession, folder: str) -> DataFrame:
    """(report, label, value) of the whole chain: all receipts as one announced batch of messages, stored, loaded, built, forecast
    with the default forest, and reported."""
    path, batch = scratch_path(spark, "chain"), "scheduled__2026-07-01T00:00:00+00:00"
    raw = pipeline.Raw(f"{path}/crm", f"{path}/products", f"{path}/pos")
    json_files.write_snapshot(_raw_customers(spark, folder), raw.customers)
    json_files.write_snapshot(_raw_products(spark, folder), raw.products)
    receipts = _kept(spark, _receipts(spark, folder).withColumn("batch_id", F.lit(batch)), "chain-receipts")
    expected = receipts.count()
    pipeline.store_batch(messages.encode(receipts), raw.events, batch, expected)

    name = "tillmart_" + path[-12:]
    settings = pipeline.Settings(silver=f"{name}_silver", gold=f"{name}_gold", location=path)
    found = pipeline.run(spark, raw, batch, expected, settings)
    value = {"kpi_avg_check": 4}
    parts = []
    for report, frame in found.items():
        text = F.lit(None).cast("string") if len(frame.columns) == 1 else F.col(frame.columns[0]).cast("string")
        rows = frame.select(text.alias("label"), F.round(F.col(frame.columns[-1]).cast("double"), value.get(report, 2)).alias("value"))
        parts.append(rows.select(F.lit(report).alias("report"), "label", "value"))
    status = spark.createDataFrame([(found.forecast.model_name, float(found.forecast.days))], "label STRING, value DOUBLE")
    parts.append(status.select(F.lit("forecast_days").alias("report"), "label", "value"))
    result = _kept(spark, reduce(DataFrame.unionByName, parts), "chain-reports")
    for database in (settings.silver, settings.gold):
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


def pipeline_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All reports of the whole chain. A forecast day has 1 if the trained model gave it a finite value, else 0: the values
    themselves have no SQL and are those of :func:`pipeline_forecast`."""
    found, value = _chain(spark, folder).where("report <> 'forecast_days'"), F.col("value")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return found.withColumn("value", F.when(F.col("report") == "trend_forecast", finite.cast("double")).otherwise(value))


def pipeline_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast that the whole chain ends with, and its model and number of days."""
    return _chain(spark, folder).where("report IN ('trend_forecast', 'forecast_days')")


# Features and forecast ------------------------------------------------------
def _category_days(spark: SparkSession, folder: str) -> DataFrame:
    return gold.revenue_by_day(fact_sales(spark, folder), "category").withColumn("revenue", F.round("revenue", 2))


def _rounded_means(frame: DataFrame) -> DataFrame:
    return frame.withColumns({f"revenue_rolling_{k}": F.round(f"revenue_rolling_{k}", 4) for k in features.ROLLING})


def daily_features(spark: SparkSession, folder: str) -> DataFrame:
    daily = sales_daily(spark, folder).select("sale_date", "revenue")
    return _rounded_means(features.features(daily))


def series_features(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_means(features.features(_category_days(spark, folder), ["category"]))


def next_day_features(spark: SparkSession, folder: str) -> DataFrame:
    last = features.last_values(_category_days(spark, folder), ["category"])
    ahead = last.withColumns(features.next_features(F.col("last_date"), F.col("recent")))
    return _rounded_means(
        ahead.select("category", F.date_add("last_date", 1).alias("sale_date"), *features.FEATURES)
    )


def history_gate(spark: SparkSession, folder: str) -> DataFrame:
    """One series per customer; some have bought on enough days and some have not."""
    days = gold.revenue_by_day(fact_sales(spark, folder), "customer_id")
    return features.history_gate(days, ["customer_id"])


def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    panel = features.features(_category_days(spark, folder), ["category"]).select("category", "sale_date")
    last = features.split(panel, ["category"]).withColumnRenamed("is_holdout", "is_last")
    return features.split(last, ["category"], 0.2).withColumnRenamed("is_holdout", "is_last_fifth")


def _candidate_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two ready-made predictions, last week's value and last week's mean, scored on the newest fifth."""
    panel = features.features(_category_days(spark, folder), ["category"])
    holdout = features.split(panel, ["category"], 0.2).where("is_holdout")
    candidates = F.stack(
        F.lit(2), F.lit("lag_7"), "revenue_lag_7", F.lit("rolling_7"), "revenue_rolling_7"
    ).alias("model_name", "prediction")
    predicted = holdout.select("category", "revenue", candidates)
    scores = features.mean_absolute_error(predicted, ["category", "model_name"])
    return scores.withColumn("mae", F.round("mae", 4))


def candidate_mae(spark: SparkSession, folder: str) -> DataFrame:
    return _candidate_scores(spark, folder)


def best_candidate(spark: SparkSession, folder: str) -> DataFrame:
    ranked = features.rank_candidates(_candidate_scores(spark, folder), ["category"], ["lag_7", "rolling_7"])
    return ranked.where("rank = 1").drop("rank")


def _kept_panel(spark: SparkSession, folder: str) -> DataFrame:
    checkpoint_root(spark)
    return forecast.training_panel(_category_days(spark, folder), ["category"]).checkpoint()


def linear_model_mae(spark: SparkSession, folder: str) -> DataFrame:
    """The linear candidate alone, trained without the newest row of each category and scored on it."""
    panel = _kept_panel(spark, folder)
    model = forecast.estimator(forecast.LINEAR).fit(panel.where("not is_holdout"))
    scores = features.mean_absolute_error(model.transform(panel.where("is_holdout")), ["category"])
    return scores.withColumn("mae", F.round("mae", 1))


def merged_linear_mae(spark: SparkSession, folder: str) -> DataFrame:
    """The linear candidate from sums of products that are kept by year and added up, on the newest row of each category."""
    panel = _kept_panel(spark, folder)
    train = panel.where("not is_holdout").withColumn("year", F.year("sale_date"))
    years = _kept(spark, least_squares.moments(train, ["year"], least_squares.origins(train), within=()), "sums-by-year")
    fit = least_squares.solved(least_squares.merged([years]))
    scores = features.mean_absolute_error(least_squares.predicted(panel.where("is_holdout"), fit), ["category"])
    return scores.withColumn("mae", F.round("mae", 1))


def linear_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The linear candidate alone, trained on all rows and rolled seven days ahead for each category."""
    days = _kept(spark, _category_days(spark, folder), "category-days")
    model = forecast.estimator(forecast.LINEAR).fit(forecast.training_panel(days, ["category"]))
    states = features.last_values(days, ["category"])
    ahead = forecast.roll_forward(states.withColumn("model_name", F.lit(forecast.LINEAR)), model, ["category"], 7)
    return ahead.select("category", "sale_date", F.round("revenue_forecast", 1).alias("revenue_forecast"))


# One tree of one split on the weekday: its best split and means can be written down in SQL.
STUMP = forecast.ForestSettings(trees=1, max_depth=1, columns=("dow",), bootstrap=False)


def selected_model(spark: SparkSession, folder: str) -> DataFrame:
    """Both candidates, the forest being a single small tree, scored for each category and ranked."""
    scores = forecast.score(_kept_panel(spark, folder), ["category"], STUMP)
    return scores.withColumn("mae", F.round("mae", 1))


def selected_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Select, refit, roll seven days ahead and stamp: each category by the candidate that won on it."""
    days = _kept(spark, _category_days(spark, folder), "category-days")
    found = forecast.forecast(days, ["category"], 7, STUMP, generated_at=AS_OF)
    return found.withColumn("revenue_forecast", F.round("revenue_forecast", 1))


def model_mae(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.score(_kept_panel(spark, folder), ["category"])


def revenue_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.forecast(sales_daily(spark, folder))


def trend_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Over the linear candidate's forecasts of all categories."""
    trend = reports.trend_forecast(linear_forecast(spark, folder))
    return trend.withColumn("forecast", F.round("forecast", 1))


# Streaming ------------------------------------------------------------------
def stream_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Events as receipts of one line: k units for the event's value."""
    events = star_schema.read(spark, folder, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    receipts = stream.select(
        F.col("event_id").alias("transaction_id"),
        "ts",
        F.from_json("props", "k BIGINT")["k"].alias("items_sold"),
        F.col("value").alias("revenue"),
    )
    path = scratch_path(spark, "daily")
    query = daily_stream.maintain(daily_stream.daily_sales(receipts), f"{path}/days", f"{path}/checkpoint")
    query.awaitTermination()
    revenue = F.round("revenue", 2)
    return daily_stream.read_daily(spark, f"{path}/days").withColumns(
        {"revenue": revenue, "avg_check": revenue / F.col("transactions_count")}
    )


def stream_receipts_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Nested receipts of known customers, through the stream that keeps the daily sales."""
    path = scratch_path(spark, "receipts-daily")
    messages.encode(_receipts(spark, folder)).write.text(f"{path}/topic")
    customers = star_schema.customers(spark, folder).select(F.col("customer_id").cast("string").alias("customer_id"))
    events = messages.strict(messages.decode(spark.readStream.text(f"{path}/topic")))
    measured = daily_stream.daily_sales(daily_stream.receipt_measures(events, customers))
    query = daily_stream.maintain(measured, f"{path}/days", f"{path}/checkpoint")
    query.awaitTermination()
    daily_stream.require_none_late(query)
    revenue = F.round("revenue", 2)
    return daily_stream.read_daily(spark, f"{path}/days").withColumns(
        {"revenue": revenue, "avg_check": revenue / F.col("transactions_count")}
    )


def stream_closed_days(spark: SparkSession, folder: str) -> DataFrame:
    """Headers and lines as two streams, joined and added up; a last message in each, some days later, closes all days."""
    path = scratch_path(spark, "closed-days")
    headers = star_schema.transactions(spark, folder).select("transaction_id", "ts", "customer_id")
    items = star_schema.items(spark, folder).select("transaction_id", "product_id", "quantity", "unit_price")
    lines = items.join(headers.select("transaction_id", "ts"), "transaction_id").select("transaction_id", "ts", "product_id", "quantity", "unit_price")
    later = F.max("ts") + F.expr("INTERVAL 10 DAYS")
    end = headers.agg(F.min("transaction_id").alias("transaction_id"), later.alias("ts"), F.min("customer_id").alias("customer_id"))
    unsold = lines.agg(
        F.min("transaction_id").alias("transaction_id"), later.alias("ts"), F.min("product_id").alias("product_id"), F.lit(0).alias("quantity"), F.lit(0.0).alias("unit_price")
    )
    # the first receipt's id, too late to meet its lines, and a line too late to meet its receipt
    unsold = unsold.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS"))
    streams = []
    for name, frame, last in (("headers", headers, end), ("lines", lines, unsold)):
        with brief_shuffles(spark):
            frame.unionByName(last).write.parquet(f"{path}/{name}")
        streams.append(spark.readStream.schema(spark.read.parquet(f"{path}/{name}").schema).parquet(f"{path}/{name}"))
    fact = fact_stream.lines_of_known_receipts(*streams, star_schema.customers(spark, folder), star_schema.products(spark, folder))
    query = daily_stream.maintain(fact_stream.closed_days(fact), f"{path}/days", f"{path}/checkpoint", "append")
    query.awaitTermination()
    daily_stream.require_none_late(query)
    revenue = F.round("revenue", 2)
    days = daily_stream.read_daily(spark, f"{path}/days")
    return days.withColumns({"revenue": revenue, "avg_check": revenue / F.col("transactions_count")})


def stream_raw(spark: SparkSession, folder: str) -> DataFrame:
    """What the stream put into Raw, counted by batch against what the receipts announce."""
    receipts = _receipts(spark, folder)
    announced = receipts.groupBy("batch_id").agg(F.count("*").alias("expected"))
    stored = ingest_stream.read_raw(spark, _ingested(spark, receipts))
    return quality.check_batches(stored, announced).select("batch_id", "expected", "received", "passed")


def stream_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Every fiftieth receipt comes as a damaged message, which is kept apart as it came."""
    receipts = _receipts(spark, folder).withColumn("key", F.col("transaction_id").cast("bigint"))
    whole = messages.encode(receipts.where("key % 50 <> 0").drop("key"))
    damaged = receipts.where("key % 50 = 0 and part = 0").select(F.concat(F.lit("broken "), "transaction_id").alias("value"))
    targets = _ingested(spark, whole.unionByName(damaged), encoded=True)
    kept = spark.read.parquet(targets.rejected)
    return kept.select("message", F.element_at("problems", 1).alias("problem"))


def _ingested(spark: SparkSession, events: DataFrame, encoded: bool = False) -> ingest_stream.Targets:
    path = scratch_path(spark, "ingest")
    _sent(events if encoded else messages.encode(events), f"{path}/topic")
    targets = ingest_stream.Targets.below(path)
    topic = spark.readStream.text(f"{path}/topic")
    ingest_stream.ingest(topic, targets, f"{path}/checkpoint").awaitTermination()
    return targets


def _sent(texts: DataFrame, path: str) -> None:
    """Messages on their way are compressed, as a producer's batches are."""
    texts.write.option("compression", "gzip").text(path)


def stream_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """One announced batch out of a topic with all batches: the read ends at the announced count, and all of it is in Raw."""
    path = scratch_path(spark, "bounded")
    receipts = _receipts(spark, folder)
    _sent(messages.encode(receipts), f"{path}/topic")
    announced = receipts.where(F.col("batch_id") == BOUNDED_BATCH).count()
    targets = ingest_stream.Targets.below(path)
    topic = spark.readStream.text(f"{path}/topic")
    outcome = ingest_stream.ingest_batch(topic, targets, f"{path}/checkpoint", BOUNDED_BATCH, announced, total=3600)
    stored = json_files.read_raw_batch(spark, targets.raw, BOUNDED_BATCH)
    return stored.agg(F.count("*").alias("received")).select(
        F.lit(BOUNDED_BATCH).alias("batch_id"), F.lit(announced).cast("bigint").alias("expected"), "received", F.lit(outcome.reason).alias("ended_by")
    )


def stream_ingest_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return ingest_stream.read_transactions(spark, _ingested(spark, _receipts(spark, folder)))


def stream_ingest_items(spark: SparkSession, folder: str) -> DataFrame:
    return ingest_stream.read_items(spark, _ingested(spark, _receipts(spark, folder)))


ALL: tuple[Query, ...] = (
    fact_sales, sales_daily, product_sales, federated_region,
    kpi_revenue, kpi_transactions, kpi_avg_check,
    trend_revenue, trend_revenue_limited, trend_revenue_range, trend_revenue_monthly, trend_transactions, top10_products,
    silver_customers, silver_products, silver_transactions, silver_items_flatten,
    receipt_total_reconcile, timestamp_normalize,
    batch_id_sanitize, batch_filter, batch_completeness, event_json_roundtrip,
    gold_row_counts, gold_validation, orphan_report,
    insert_if_absent, as_of_read, table_refresh_append, incremental_marts, fact_calendar, raw_batch_files, raw_array_files, pipeline_reports, pipeline_forecast,
    daily_features, series_features, next_day_features, history_gate, holdout_split,
    candidate_mae, best_candidate, linear_model_mae, merged_linear_mae, linear_forecast,
    selected_model, selected_forecast, model_mae, revenue_forecast, trend_forecast,
    stream_daily_sales, stream_ingest_transactions, stream_ingest_items,
    stream_receipts_daily, stream_closed_days, stream_raw, stream_rejected, stream_bounded,
)


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(tune(spark), folder)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {query.__name__: _tuned(query) for query in ALL}
