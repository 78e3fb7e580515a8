"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.session import scratch_path

# Rows that a Python task is handed at once. Spark counts rows and not bytes, and texts are long.
ROWS_AT_ONCE = 500


def few_at_once(docs: DataFrame) -> DataFrame:
    """The same rows; the session hands its Python tasks at most ``ROWS_AT_ONCE`` rows at a time from now on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(name)) <= ROWS_AT_ONCE:
        conf.set(name, str(ROWS_AT_ONCE))
    return docs


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand their Python tasks at most so many rows at a time; the session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read again: a lost executor costs no recomputation."""
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def smallest_hashes(frame: DataFrame, columns: list[str], most: int, rows: int, distinct: bool = False) -> DataFrame:
    """At most ``most`` rows, if asked each once: those whose ``columns`` have the smallest hash, whatever their order or partitions.

    ``rows`` is the number of rows, or less. Only rows below a bound that some two times ``most`` of so many pass are sorted, so what the
    tasks send on does not grow with their number.
    """
    value = F.xxhash64(*columns)
    share = (2 * most + 200) / max(1, rows)
    if share < 1:
        frame = frame.where(value <= -(1 << 63) + int(share * (1 << 64)))
    if distinct:
        frame = frame.distinct()
    return frame.orderBy(value, *columns).limit(most)
