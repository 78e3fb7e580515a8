"""What the queries return beyond their agreement with SQL."""

import datetime as dt

import pytest

from tests.rows import event, messages, silver
from tillmart import schemas
from tillmart.plans import incremental, pipeline, queries
from tillmart.sources import json_files, star_schema
from tillmart.sources.messages import decode, strict


def test_the_chart_limit_keeps_more_than_500_days(spark, monkeypatch):
    day = dt.date(2020, 1, 1)
    daily = spark.createDataFrame([(day + dt.timedelta(days=n), 1, 1, 1.0, 1.0) for n in range(700)], schemas.SALES_DAILY)
    monkeypatch.setattr(queries, "sales_daily", lambda spark, folder: daily)
    assert queries.trend_revenue_limited(spark, "").count() == 700


def test_reports_of_the_chain_hold_the_forecast(spark, monkeypatch):
    rows = [("kpi_revenue", None, 5.5), ("forecast_days", "RandomForest", 7.0)]
    rows += [("trend_forecast", label, value) for label, value in (("a", 12.25), ("b", float("nan")), ("c", None))]
    chain = spark.createDataFrame(rows, "report string, label string, value double")
    monkeypatch.setattr(queries, "_chain", lambda spark, folder: chain)
    found = {(r.report, r.label): r.value for r in queries.pipeline_reports(spark, "").collect()}
    assert found == {("kpi_revenue", None): 5.5, ("trend_forecast", "a"): 1.0, ("trend_forecast", "b"): 0.0, ("trend_forecast", "c"): 0.0}


def test_many_batches_and_topics_are_stored_compressed(spark, tmp_path):
    sent = messages(spark, event(1), event(2, batch_id="other"))
    events = strict(decode(sent))
    json_files.write_raw_batches(events, f"{tmp_path}/raw")
    files = [f.name for f in (tmp_path / "raw").rglob("part-*")]
    assert len(files) == 2 and all(name.endswith(".json.gz") for name in files)
    stored = json_files.read_snapshot(spark, f"{tmp_path}/raw", schemas.POS_EVENT)
    assert sorted(r.transaction_id for r in stored.collect()) == ["TXN-1", "TXN-2"]
    assert json_files.read_raw_batch(spark, f"{tmp_path}/raw", "other").count() == 1
    queries._sent(sent, f"{tmp_path}/topic")
    assert all(f.name.endswith(".txt.gz") for f in (tmp_path / "topic").glob("part-*"))
    assert spark.read.text(f"{tmp_path}/topic").exceptAll(sent).isEmpty()


def test_a_batch_brings_the_lines_of_its_own_receipts(spark, monkeypatch):
    transactions = [(n, dt.datetime(1997 + n % 2, 1, 1), "s", "c1", 1.0, "card") for n in range(12)]
    frames = silver(spark, transactions=[(str(n), *rest) for n, *rest in transactions], items=[(str(n), "p1", 1, 1.0) for n in range(12)])
    t, c, i, p = (f.withColumn("transaction_id", f["transaction_id"].cast("bigint")) if "transaction_id" in f.columns else f for f in frames)
    monkeypatch.setattr(star_schema, "silver", lambda spark, folder: star_schema.Silver(c, p, t, i))
    given = []

    def apply(spark, marts, name, transactions, customers, items, products):
        given.append([sorted(r.transaction_id for r in f.collect()) for f in (transactions, items)])
        if len(given) == 4:
            raise InterruptedError

    monkeypatch.setattr(incremental, "apply_batch", apply)
    with pytest.raises(InterruptedError):
        queries.incremental_marts(spark, "")
    ids = [[n for n in range(12) if n % 3 == k] for k in range(3)]
    early = [n for n in range(12) if n % 3 and n % 2 == 0]
    assert given == [[ids[0], ids[0]], [early, sorted(ids[1] + ids[2])], [ids[1], ids[1]], [ids[2], ids[2]]]


def test_a_stored_batch_is_counted_by_its_write(spark, tmp_path, monkeypatch):
    real, reads = json_files.read_raw_batch, []
    monkeypatch.setattr(json_files, "read_raw_batch", lambda *arguments: reads.append(1) or real(*arguments))
    topic, batch = messages(spark, event(1), event(2), event(3, batch_id="other")), event()["batch_id"]
    with pytest.raises(ValueError, match="expected 3 events, received 2"):
        pipeline.store_batch(topic, f"{tmp_path}/pos", batch, 3)
    assert len(reads) == 1  # whether the folder holds another batch
    pipeline.store_batch(topic, f"{tmp_path}/pos", batch, 2)
    assert real(spark, f"{tmp_path}/pos", batch).count() == 2
