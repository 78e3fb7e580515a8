"""A lookup table in an external relational database, over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmart import schemas
from tillmart.operators.gold import insert_if_absent


def partition_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Read a large table over several connections, split by a numeric or date column.

    Rows outside the bounds are read too, by the first and the last connection.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Scan a foreign table. Filters, column choice and aggregates are pushed to the database."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def ensure_country_region(spark: SparkSession, url: str, table: str = "country_region", **options: str) -> None:
    """Create the lookup if it does not exist; its key is kept by :func:`add_countries`."""
    (
        spark.createDataFrame([], schemas.COUNTRY_REGION)
        .write.format("jdbc")
        .mode("ignore")
        .options(
            url=url, dbtable=table, createTableColumnTypes=schemas.COUNTRY_REGION_COLUMNS, **options
        )
        .save()
    )


def add_countries(rows: DataFrame, url: str, table: str = "country_region", **options: str) -> None:
    """Insert the countries that the lookup does not have yet."""
    existing = read_table(rows.sparkSession, url, table, **options)
    new = insert_if_absent(existing, rows, ["country"])
    new.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()
