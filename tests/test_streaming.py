"""Streams give what batches give, and a replay adds nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.rows import event, messages, text
from tillmart.operators import gold, silver
from tillmart.sources import json_files
from tillmart.sources.messages import decode, strict
from tillmart.streaming import daily, fact, ingest


def deliver(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(d if isinstance(d, str) else text(d) for d in documents))


def test_ingest(spark, tmp_path):
    targets = ingest.Targets.below(f"{tmp_path}/lake")

    def run():
        topic = spark.readStream.text(str(tmp_path / "topic"))
        ingest.ingest(topic, targets, f"{tmp_path}/checkpoint").awaitTermination()

    poison = event(5, timestamp="the 4th of July")
    first, second = [event(1), event(2, items=[])], [event(3), event(4, store_id=...), "not json", poison]
    deliver(tmp_path / "topic", "1.txt", *first)
    run()
    run()
    deliver(tmp_path / "topic", "2.txt", *second)
    run()

    events = strict(decode(messages(spark, *first, event(3))))
    for found, expected in (
        (ingest.read_transactions(spark, targets), silver.to_transactions(events)),
        (ingest.read_items(spark, targets), silver.to_items(events)),
        (ingest.read_raw(spark, targets), events),
    ):
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    assert json_files.read_raw_batch(spark, targets.raw, event(1)["batch_id"]).count() == 3
    kept = sorted((row.problems, row.message) for row in spark.read.parquet(targets.rejected).collect())
    assert kept == [(["malformed"], "not json"), (["store_id"], text(event(4, store_id=...))), (["timestamp value"], text(poison))]


@pytest.fixture
def receipts():
    return [
        event(n, timestamp=f"2026-07-{4 + n % 3:02d}T{8 + n % 12:02d}:10:00+03:00", customer_id="c1")
        for n in range(60)
    ]


def test_daily_stream_equals_batch(spark, tmp_path, receipts):
    """Three deliveries in time order, each with every receipt twice, a replay of the last, and the batch job."""
    receipts.sort(key=lambda r: r["timestamp"])

    def run():
        topic = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "topic"))
        events = strict(decode(topic))
        measured = daily.daily_sales(daily.receipt_measures(events))
        daily.maintain(measured, f"{tmp_path}/days", f"{tmp_path}/checkpoint").awaitTermination()

    for n in range(3):
        part = receipts[n * 20 : (n + 1) * 20]
        deliver(tmp_path / "topic", f"{n}.txt", *part, *part)
        run()
    deliver(tmp_path / "topic", "3.txt", *receipts[40:])
    run()

    events = strict(decode(messages(spark, *receipts)))
    lines = silver.to_transactions(events).join(silver.to_items(events), "transaction_id")
    expected = gold.sales_daily(lines.withColumn("line_amount", F.col("quantity") * F.col("unit_price")))
    found = daily.read_daily(spark, f"{tmp_path}/days")
    assert found.count() == 3
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_empty_receipts_unknown_customers_and_late_ones(spark, tmp_path):
    deliver(tmp_path / "topic", "1.txt", event(1), event(2, items=[]), event(3, customer_id="nobody"))
    deliver(tmp_path / "topic", "2.txt", event(4, timestamp="2026-07-20T10:00:00"))
    deliver(tmp_path / "topic", "3.txt", event(5, timestamp="2026-07-01T10:00:00"))
    customers = spark.createDataFrame([(event(1)["customer_id"],)], "customer_id string")
    topic = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "topic"))
    measured = daily.daily_sales(daily.receipt_measures(strict(decode(topic)), customers))
    query = daily.maintain(measured, f"{tmp_path}/days", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    found = sorted((row.transactions_count, row.avg_check) for row in daily.read_daily(spark, f"{tmp_path}/days").collect())
    assert found == [(1, 210.5), (1, 210.5)]
    assert daily.late_rows(query) == 1
    with pytest.raises(ValueError, match="1 rows came later"):
        daily.require_none_late(query)


def test_receipts_keep_their_wall_clock(spark):
    events = strict(decode(messages(spark, event(1, timestamp="2026-07-04T23:30:00-05:00"))))
    row = daily.receipt_measures(events).first()
    assert tuple(row) == ("TXN-1", dt.datetime(2026, 7, 4, 23, 30), 3, 210.5, 0)


def test_two_streams(spark, tmp_path):
    """Headers and lines apart, lines first, in several micro-batches: only closed days come, each once and equal to the batch mart."""
    at = dt.datetime(2026, 7, 4, 9)
    headers = [(f"T{n}", at + dt.timedelta(hours=7 * n), "c1" if n % 5 else "nobody") for n in range(30)] + [(None, at, "c1")]
    lines = [(h[0], h[1], p, 2, 1.5 + n) for n, h in enumerate(headers) for p in ("p1", "p1", "p2", "unknown")[: 1 + n % 4]]
    shapes = "transaction_id string, ts timestamp_ntz, customer_id string", "transaction_id string, ts timestamp_ntz, product_id string, quantity int, unit_price double"
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    products = spark.createDataFrame([("p1",), ("p2",)], "product_id string")
    far = at + dt.timedelta(days=40)

    def run(*new):
        for name, rows, shape in zip(("headers", "lines"), new, shapes):
            spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        topics = [spark.readStream.schema(shape).parquet(f"{tmp_path}/{name}") for name, shape in zip(("headers", "lines"), shapes)]
        met = fact.lines_of_known_receipts(*topics, customers, products)
        query = daily.maintain(fact.closed_days(met), f"{tmp_path}/days", f"{tmp_path}/checkpoint", "append")
        query.awaitTermination()
        daily.require_none_late(query)
        return sorted(map(tuple, daily.read_daily(spark, f"{tmp_path}/days").collect()))

    known = {h[0]: h[1] for h in headers if h[0] and h[2] == "c1"}
    wanted = {}
    for receipt, ts, product, quantity, price in lines:
        if receipt in known and product in ("p1", "p2"):
            seen, units, revenue = wanted.setdefault(ts.date(), (set(), 0, 0.0))
            wanted[ts.date()] = (seen | {receipt}, units + quantity, revenue + quantity * price)
    wanted = [(day, len(seen), units, revenue, revenue / len(seen)) for day, (seen, units, revenue) in sorted(wanted.items())]

    first, second = [h for h in headers if h[1] < at + dt.timedelta(days=4)], [h for h in headers if h[1] >= at + dt.timedelta(days=4)]
    early, rest = [x for x in lines if x[1] < at + dt.timedelta(days=4, hours=12)], [x for x in lines if x[1] >= at + dt.timedelta(days=4, hours=12)]
    found = run(first, early)
    assert found == wanted[: len(found)] and len(found) < 4
    found = run(second + [("end", far, "c1")], rest + [("last", far, "p1", 1, 1.0)])
    assert found == wanted


def test_large_state_is_stored_once(spark, tmp_path):
    """What a micro-batch adds to the state is in the files of the store alone, not in a log of the changes as well."""
    at = dt.datetime(2026, 7, 4, 9)
    headers = [(n, at, n % 7) for n in range(30000)] + [(-1, at + dt.timedelta(days=10), 0)]
    lines = [(n, at, n % 5, 1, 2.0) for n in range(30000)] + [(-2, at + dt.timedelta(days=10), 0, 0, 0.0)]
    shapes = "transaction_id bigint, ts timestamp_ntz, customer_id bigint", "transaction_id bigint, ts timestamp_ntz, product_id bigint, quantity int, unit_price double"
    for name, rows, shape in zip(("headers", "lines"), (headers, lines), shapes):
        spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/{name}")
    topics = [spark.readStream.schema(shape).parquet(f"{tmp_path}/{name}") for name, shape in zip(("headers", "lines"), shapes)]
    met = fact.lines_of_known_receipts(*topics, spark.range(7).toDF("customer_id"), spark.range(5).toDF("product_id"))
    query = daily.maintain(fact.closed_days(met), f"{tmp_path}/days", f"{tmp_path}/checkpoint", "append")
    query.awaitTermination()
    daily.require_none_late(query)
    assert [tuple(row)[1:4] for row in daily.read_daily(spark, f"{tmp_path}/days").collect()] == [(30000, 30000, 60000.0)]
    state = [f for f in (tmp_path / "checkpoint" / "state").rglob("*") if f.is_file() and not f.name.startswith(".")]
    assert any(f.suffix == ".sst" for f in state) and not any(f.suffix == ".changelog" for f in state)
