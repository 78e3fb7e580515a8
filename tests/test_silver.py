"""Typing, flattening and checked decoding of raw rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.rows import event, messages
from tillmart import schemas
from tillmart.functions import event_time, receipt_total, safe_batch_id, try_event_time
from tillmart.operators import silver
from tillmart.sources.messages import accepted, decode, encode, rejected, strict


@pytest.mark.parametrize("suffix", ["+00:00", "Z", "+03:00", "-05:00", ""])
def test_wall_clock_survives_every_offset(spark, suffix):
    frame = spark.createDataFrame([(f"2026-07-04T17:10:00{suffix}",)], "t STRING")
    assert frame.select(event_time(F.col("t"))).first()[0] == dt.datetime(2026, 7, 4, 17, 10)


def test_bad_time_raises_or_is_null(spark):
    frame = spark.createDataFrame([("yesterday",)], "t STRING")
    assert frame.select(try_event_time(F.col("t"))).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        frame.select(event_time(F.col("t"))).collect()


def test_colliding_batch_ids_keep_their_originals(spark):
    frame = spark.createDataFrame([("a:b",), ("a_b",), ("x-1.2+3",)], "id STRING")
    found = [tuple(row) for row in frame.select("id", safe_batch_id(F.col("id"))).collect()]
    assert found == [("a:b", "a_b"), ("a_b", "a_b"), ("x-1.2+3", "x-1.2_3")]


def test_missing_customer_field_is_null_and_extra_ignored(spark):
    row = '{"customer_id": "c9", "last_name": "O\'Neil", "city": "Tver", "registration_date": "2026-01-02", "x": 1}'
    raw = messages(spark, row).select(F.from_json("value", schemas.RAW_CUSTOMER).alias("r")).select("r.*")
    frame = silver.to_customers(raw)
    assert frame.schema == schemas.CUSTOMERS
    found = frame.first()
    assert (found.last_name, found.city, found.email) == ("O'Neil", "Tver", None)
    assert found.registration_date == dt.date(2026, 1, 2)


def test_bad_value_raises(spark):
    raw = spark.createDataFrame([("c1", "not a date")], "customer_id STRING, registration_date STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.to_customers(raw).collect()


def test_empty_items_keep_the_transaction(spark):
    events = strict(decode(messages(spark, event(1), event(2, items=[]))))
    assert silver.to_transactions(events).count() == 2
    lines = silver.to_items(events)
    assert lines.schema == schemas.ITEMS
    assert {(row.transaction_id, row.product_id) for row in lines.collect()} == {("TXN-1", "p1"), ("TXN-1", "p3")}


@pytest.mark.parametrize("field", schemas.EVENT_REQUIRED)
def test_missing_field_raises(spark, field):
    with pytest.raises(Exception, match=f"missing: {field}"):
        strict(decode(messages(spark, event(1), event(2, **{field: ...})))).collect()


def test_problems_are_kept_apart(spark):
    decoded = decode(
        messages(
            spark,
            event(1),
            event(2, store_id=None),
            event(3, store_id=...),
            event(4, items=[{"product_id": "p1", "quantity": 1}]),
            event(5, items=[{"product_id": None, "quantity": 1, "unit_price": 1.0}]),
            event(6, items=None),
            event(7, total_amount="much"),
            "not json",
        )
    )
    assert {row.transaction_id for row in accepted(decoded).collect()} == {"TXN-1", "TXN-2", "TXN-5"}
    problems = sorted(row.problems for row in rejected(decoded).collect())
    assert problems == [["item field"], ["items"], ["malformed"], ["malformed"], ["store_id"]]


def test_encode_and_decode_keep_text(spark):
    events = strict(decode(messages(spark, event(1), event(2, customer_id=None))))
    encoded = encode(events)
    assert "МОС" in encoded.first().value
    again = strict(decode(encoded))
    assert again.exceptAll(events).isEmpty() and events.exceptAll(again).isEmpty()


def test_batch_filter_never_matches_missing_ids(spark):
    events = strict(decode(messages(spark, event(1), event(2, batch_id="other"), event(3, batch_id=...))))
    mine = silver.of_batch(events, "manual__2026-07-04T00:00:00+00:00")
    assert [row.transaction_id for row in mine.collect()] == ["TXN-1"]


def test_receipt_total(spark):
    events = strict(decode(messages(spark, event(1), event(2, items=[]))))
    assert [row[0] for row in events.select(receipt_total(F.col("items"))).collect()] == [210.5, 0.0]
