"""Every query with SQL gives the same rows in an independent engine."""

import os

import duckdb
import pytest

from tillmart.plans.oracle import SQL
from tillmart.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(row[n] for n in order) for row in rows), key=repr)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "decimal(10,2)": "DECIMAL(10,2)",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    columns = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = normal(result.fetchall(), columns)
    actual = normal([tuple(row) for row in frame.collect()], frame.columns)
    assert sorted(frame.columns) == sorted(columns)
    assert {name: TYPES[kind] for name, kind in frame.dtypes} == types
    assert len(actual) == len(expected) > 0
    assert actual == expected


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)
