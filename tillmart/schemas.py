"""Table contracts.

Fixed values: column names, their order and their types are the data contract
that readers of the tables rely on.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, INT, BIGINT, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
DATE, TIMESTAMP_NTZ = DateType(), TimestampNTZType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Raw layer -----------------------------------------------------------------
RAW_CUSTOMER = _table(
    customer_id=STRING,
    first_name=STRING,
    last_name=STRING,
    email=STRING,
    city=STRING,
    segment=STRING,
    registration_date=STRING,
    ingestion_batch_date=STRING,
)
RAW_PRODUCT = _table(
    product_id=STRING,
    name=STRING,
    category=STRING,
    brand=STRING,
    price=DOUBLE,
    currency=STRING,
)
POS_EVENT = _table(
    batch_id=STRING,
    transaction_id=STRING,
    timestamp=STRING,
    store_id=STRING,
    customer_id=STRING,
    items=ArrayType(_table(product_id=STRING, quantity=INT, unit_price=DOUBLE)),
    total_amount=DOUBLE,
    payment_method=STRING,
    # Number of the document for a receipt that is spread over several, from 0; absent for a whole receipt.
    part=INT,
)
# A receipt without one of these cannot be loaded.
EVENT_REQUIRED = (
    "transaction_id", "timestamp", "store_id", "customer_id", "items", "total_amount", "payment_method",
)
ITEM_REQUIRED = ("product_id", "quantity", "unit_price")

# Silver layer --------------------------------------------------------------
CUSTOMERS = _table(
    customer_id=STRING,
    first_name=STRING,
    last_name=STRING,
    email=STRING,
    city=STRING,
    segment=STRING,
    registration_date=DATE,
    ingestion_batch_date=DATE,
)
PRODUCTS = _table(
    product_id=STRING,
    name=STRING,
    category=STRING,
    brand=STRING,
    price=DOUBLE,
    currency=STRING,
)
TRANSACTIONS = _table(
    transaction_id=STRING,
    ts=TIMESTAMP_NTZ,
    store_id=STRING,
    customer_id=STRING,
    total_amount=DOUBLE,
    payment_method=STRING,
)
ITEMS = _table(
    transaction_id=STRING,
    product_id=STRING,
    quantity=INT,
    unit_price=DOUBLE,
)

# Gold layer ----------------------------------------------------------------
FACT_SALES = _table(
    transaction_id=STRING,
    ts=TIMESTAMP_NTZ,
    store_id=STRING,
    customer_id=STRING,
    first_name=STRING,
    last_name=STRING,
    city=STRING,
    segment=STRING,
    product_id=STRING,
    product_name=STRING,
    category=STRING,
    brand=STRING,
    quantity=INT,
    unit_price=DOUBLE,
    line_amount=DOUBLE,
    payment_method=STRING,
)
SALES_DAILY = _table(
    sale_date=DATE,
    transactions_count=BIGINT,
    items_sold=BIGINT,
    revenue=DOUBLE,
    avg_check=DOUBLE,
)
PRODUCT_SALES = _table(
    product_id=STRING,
    product_name=STRING,
    category=STRING,
    brand=STRING,
    units_sold=BIGINT,
    revenue=DOUBLE,
)
REVENUE_FORECAST = _table(
    sale_date=DATE,
    revenue_forecast=DOUBLE,
    model_name=STRING,
    generated_at=TIMESTAMP_NTZ,
)

# Sample tables and the external lookup -------------------------------------
LAKE_CUSTOMERS = _table(
    id=INT,
    name=STRING,
    country=STRING,
)
LAKE_ORDERS = _table(
    order_id=INT,
    customer_id=INT,
    amount=DecimalType(10, 2),
    order_date=DATE,
)
COUNTRY_REGION = _table(
    country=STRING,
    region=STRING,
)
COUNTRY_REGION_COLUMNS = "country VARCHAR(10), region VARCHAR(50)"

SILVER_TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "pos_transactions": TRANSACTIONS,
    "transaction_items": ITEMS,
}
GOLD_TABLES = {
    "fact_sales": FACT_SALES,
    "sales_daily": SALES_DAILY,
    "product_sales": PRODUCT_SALES,
}
FORECAST_TABLES = {"revenue_forecast": REVENUE_FORECAST}
SAMPLE_TABLES = {"customers": LAKE_CUSTOMERS, "orders": LAKE_ORDERS}
