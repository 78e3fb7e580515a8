"""Gold kept up to date batch by batch: only what a batch touches is read and computed again.

The fact is stored by month and batch, so a batch that is delivered again replaces its own rows. The days of the touched months are
computed anew from these months alone, which keeps the distinct count of receipts exact. Units and revenue per product and month are
computed anew for the touched months, and the product mart, which is stored by shelf (a hash of the product), adds up the months
for the touched shelves. All steps replace whole partitions, so a step that is repeated changes nothing. What a batch touched before it was
replaced is noted first and forgotten last: a run that failed is made good by running the batch again.

Names and categories are those of the snapshots that the batch was applied with.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmart import schemas
from tillmart.functions import day
from tillmart.operators import gold
from tillmart.operators.silver import conform

MONTH, BATCH, SHELF = "sale_month", "batch_id", "shelf"
_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Marts:
    """The database of the tables, the folder it lives in (default: the catalog's warehouse), and the parts of the product mart."""

    database: str
    location: str | None = None
    shelves: int = 16

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


@dataclass(frozen=True)
class Touched:
    """What a batch touched, now or as it was delivered before, and how many lines it has."""

    months: tuple[str, ...]
    shelves: tuple[int, ...]
    lines: int


_TABLES = {
    "fact_sales": (schemas.FACT_SALES, f"{MONTH} DATE, {BATCH} STRING", (MONTH, BATCH)),
    "sales_daily": (schemas.SALES_DAILY, f"{MONTH} DATE", (MONTH,)),
    "product_months": (schemas.PRODUCT_SALES, f"{SHELF} INT, {MONTH} DATE", (MONTH,)),
    "product_sales": (schemas.PRODUCT_SALES, f"{SHELF} INT", (SHELF,)),
    "pending": (StructType(), f"{MONTH} STRING, {SHELF} INT, {BATCH} STRING", (BATCH,)),
}


def create(spark: SparkSession, marts: Marts) -> None:
    at = f" LOCATION '{marts.location}'" if marts.location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {marts.database}{at}")
    for name, (schema, added, partitions) in _TABLES.items():
        columns = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] + [added])
        by = ", ".join(partitions)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {marts.table(name)} ({columns}) USING parquet PARTITIONED BY ({by})")


def month_of(ts: Column) -> Column:
    return F.trunc(day(ts), "month")


def shelf_of(product: Column, shelves: int) -> Column:
    return F.pmod(F.xxhash64(product.cast("string")), F.lit(shelves)).cast("int")


def apply_batch(
    spark: SparkSession, marts: Marts, batch_id: str, transactions: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame
) -> Touched:
    """Put the receipts of one batch in place of what was stored for it, and bring the marts up to date."""
    create(spark, marts)
    before = _noted(spark, marts, batch_id) | _touched_by(spark, marts, batch_id)
    _note(spark, marts, batch_id, before)

    fact = gold.fact_sales(transactions, customers, items, products)
    rows = conform(fact, schemas.FACT_SALES).withColumns({MONTH: month_of(F.col("ts")), BATCH: F.lit(batch_id)})
    # one file for a small month, several for a large one; days stand together, so a range of days skips row groups
    rows = rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "ts")
    lines = _replace(rows, marts.table("fact_sales"), {(m, batch_id) for m, _ in before})
    touched = before | _touched_by(spark, marts, batch_id)
    months, shelves = sorted({m for m, _ in touched}), sorted({s for _, s in touched})
    if touched:
        _refresh_days(spark, marts, months)
        _refresh_products(spark, marts, months, shelves)  # few shelves are touched only by a batch of few products
    spark.sql(f"ALTER TABLE {marts.table('pending')} DROP IF EXISTS PARTITION ({BATCH} = '{_quoted(batch_id)}')")
    return Touched(tuple(months), tuple(shelves), lines)


def of_months(spark: SparkSession, marts: Marts, months: Iterable[str]) -> DataFrame:
    """The fact of some months; other partitions are not read."""
    return spark.table(marts.table("fact_sales")).where(F.col(MONTH).isin([F.lit(m).cast("date") for m in months]))


def of_calendar(spark: SparkSession, marts: Marts, calendar: DataFrame) -> DataFrame:
    """The fact on the days of ``calendar`` (sale_date), whatever chose them.

    The join is on the month too, so the months that the calendar holds prune the fact's partitions while the query runs.
    """
    days = calendar.select("sale_date").distinct().withColumn("_month", F.trunc("sale_date", "month"))
    fact = spark.table(marts.table("fact_sales"))
    same = (fact[MONTH] == days["_month"]) & (day(fact["ts"]) == days["sale_date"])
    return fact.join(days, same).drop("_month")


def _refresh_days(spark: SparkSession, marts: Marts, months: list[str]) -> None:
    daily = gold.sales_daily(of_months(spark, marts, months)).withColumn(MONTH, F.trunc("sale_date", "month"))
    _replace(daily.hint("rebalance", MONTH), marts.table("sales_daily"), {(m,) for m in months})


def _refresh_products(spark: SparkSession, marts: Marts, months: list[str], shelves: list[int]) -> None:
    keys = ["product_id", "product_name", "category", "brand"]
    sold = of_months(spark, marts, months).groupBy(MONTH, *keys)
    by_month = sold.agg(F.sum("quantity").cast("bigint").alias("units_sold"), F.sum("line_amount").alias("revenue"))
    shelf = shelf_of(F.col("product_id"), marts.shelves).alias(SHELF)
    by_month = by_month.select(*schemas.PRODUCT_SALES.fieldNames(), shelf, MONTH)
    # sorted by shelf, so that reading a few shelves skips row groups
    by_month = by_month.hint("rebalance", MONTH).sortWithinPartitions(MONTH, SHELF)
    _replace(by_month, marts.table("product_months"), {(m,) for m in months})

    of_shelves = spark.table(marts.table("product_months")).where(F.col(SHELF).isin(shelves)).groupBy(*keys, SHELF)
    whole = of_shelves.agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
    whole = whole.select(*schemas.PRODUCT_SALES.fieldNames(), SHELF)
    _replace(whole.hint("rebalance", SHELF), marts.table("product_sales"), {(s,) for s in shelves})


def _touched_by(spark: SparkSession, marts: Marts, batch_id: str) -> set[tuple[str, int]]:
    """(month, shelf) of the stored rows of a batch: at most months times shelves, read from its own partitions."""
    rows = spark.table(marts.table("fact_sales")).where(F.col(BATCH) == batch_id)
    shelf = shelf_of(F.col("product_id"), marts.shelves)
    return {tuple(r) for r in rows.select(F.col(MONTH).cast("string"), shelf).distinct().collect()}


def _noted(spark: SparkSession, marts: Marts, batch_id: str) -> set[tuple[str, int]]:
    rows = spark.table(marts.table("pending")).where(F.col(BATCH) == batch_id).select(MONTH, SHELF)
    return {tuple(r) for r in rows.collect()}


def _note(spark: SparkSession, marts: Marts, batch_id: str, touched: set[tuple[str, int]]) -> None:
    rows = spark.createDataFrame(sorted(touched), f"{MONTH} STRING, {SHELF} INT").withColumn(BATCH, F.lit(batch_id))
    _replace(rows.coalesce(1), marts.table("pending"), set())


def _replace(frame: DataFrame, table: str, affected: set[tuple]) -> int:
    """Replace the partitions that the frame has rows for, and drop the ``affected`` ones that it has none for. Returns its rows.

    Rows and partitions are noted by the write itself; no job counts them.
    """
    spark = frame.sparkSession
    partitions = _TABLES[table.split(".")[-1]][2]
    seen = Observation()
    keys = F.struct(*[F.col(p).cast("string").alias(p) for p in partitions])
    noted = frame.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(keys).alias("partitions"))
    with _dynamic(spark):
        noted.write.mode("overwrite").insertInto(table, overwrite=True)
    written = {tuple(r) for r in seen.get["partitions"]}
    for values in sorted({tuple(map(str, a)) for a in affected} - written):
        spec = ", ".join(f"{p} = '{_quoted(v)}'" for p, v in zip(partitions, values))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)
    return seen.get["rows"]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that rows are written to; the session's setting comes back afterwards."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)
