"""Features, gates, model choice and the rolling forecast."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillmart.operators import features
from tillmart.plans import forecast as fc

SMALL = fc.ForestSettings(trees=5, max_depth=4)
START = dt.date(2026, 1, 5)


def days(spark, count, series="total", values=None, start=START):
    values = values or [100.0 + 7 * (n % 7) + n for n in range(count)]
    rows = [(series, start + dt.timedelta(days=n), values[n]) for n in range(count)]
    return spark.createDataFrame(rows, "series_id STRING, sale_date DATE, revenue DOUBLE")


def in_pandas(values):
    """The same features over a pandas series."""
    frame = pd.DataFrame({"sale_date": pd.date_range(START, periods=len(values)), "revenue": values})
    frame["dow"] = frame.sale_date.dt.dayofweek
    frame["is_weekend"] = (frame.dow >= 5).astype(int)
    for k in features.LAGS:
        frame[f"revenue_lag_{k}"] = frame.revenue.shift(k)
    for k in features.ROLLING:
        frame[f"revenue_rolling_{k}"] = frame.revenue.shift(1).rolling(k).mean()
    return frame.dropna()


@pytest.mark.parametrize("hole", [None, 12])
def test_features_equal_pandas(spark, hole):
    values = [float((n * 37) % 101) for n in range(40)]
    if hole is not None:
        values[hole] = None
    found = features.features(days(spark, 40, values=values), ["series_id"]).orderBy("sale_date").toPandas()
    expected = in_pandas(values)
    assert list(pd.to_datetime(found.sale_date)) == list(expected.sale_date)
    names = list(features.FEATURES)
    np.testing.assert_allclose(found[names].astype(float), expected[names].astype(float), atol=1e-9)


def test_weekend_flags(spark):
    found = features.features(days(spark, 15), ["series_id"]).collect()
    assert {row.sale_date.weekday(): (row.dow, row.is_weekend) for row in found} == {
        n: (n, int(n > 4)) for n in range(7)
    }


@pytest.mark.parametrize(("count", "expected"), [(13, (13, True)), (14, (7, False)), (15, (8, False))])
def test_history_gate(spark, count, expected):
    row = features.history_gate(days(spark, count), ["series_id"]).first()
    assert (row.rows_available, row.skipped) == expected


def test_gate_counts_usable_rows(spark):
    values = [1.0] * 7 + [None] * 7
    row = features.history_gate(days(spark, 14, values=values), ["series_id"]).first()
    assert (row.rows_available, row.skipped) == (0, True)


def test_holdout(spark):
    panel = days(spark, 10).unionByName(days(spark, 6, "b"))
    last = features.split(panel, ["series_id"]).where("is_holdout").groupBy("series_id").count()
    assert {tuple(row) for row in last.collect()} == {("total", 1), ("b", 1)}
    fifth = features.split(panel, ["series_id"], 0.2).where("is_holdout").groupBy("series_id").count()
    assert {tuple(row) for row in fifth.collect()} == {("total", 2), ("b", 2)}


def test_equal_scores_prefer_the_first(spark):
    scores = spark.createDataFrame(
        [("a", fc.FOREST, 2.0), ("a", fc.LINEAR, 2.0), ("b", fc.FOREST, 1.0), ("b", fc.LINEAR, 2.0)],
        "series_id STRING, model_name STRING, mae DOUBLE",
    )
    ranked = features.rank_candidates(scores, ["series_id"], fc.CANDIDATES).where("rank = 1")
    assert {(row.series_id, row.model_name) for row in ranked.collect()} == {("a", fc.LINEAR), ("b", fc.FOREST)}


def test_next_features_continue_the_series(spark):
    values = [float((n * 37) % 101) for n in range(21)]
    last = features.last_values(days(spark, 20, values=values[:20]), ["series_id"])
    found = last.select([c.alias(n) for n, c in features.next_features(F.col("last_date"), F.col("recent")).items()])
    expected = in_pandas(values).iloc[-1]
    names = list(features.FEATURES)
    np.testing.assert_allclose(found.toPandas()[names].iloc[0].astype(float), expected[names].astype(float))


def test_linear_model_is_least_squares(spark):
    rng = np.random.default_rng(3)
    values = [float(v) for v in rng.normal(1000, 100, 120)]
    panel = features.features(days(spark, 120, values=values), ["series_id"])
    model = fc.estimator(fc.LINEAR, SMALL).fit(panel).stages[-1]
    frame = in_pandas(values)
    matrix = np.column_stack([frame[list(features.FEATURES)].astype(float), np.ones(len(frame))])
    expected = np.linalg.lstsq(matrix, frame.revenue, rcond=None)[0]
    np.testing.assert_allclose([*model.coefficients, model.intercept], expected, rtol=1e-6)


def test_roll_forward_feeds_predictions_back(spark):
    """Brute force: refeed each prediction by hand through the coefficients."""
    rng = np.random.default_rng(5)
    values = [float(v) for v in rng.normal(1000, 100, 60)]
    daily = days(spark, 60, values=values)
    model = fc.estimator(fc.LINEAR, SMALL).fit(features.features(daily, ["series_id"]))
    states = features.last_values(daily, ["series_id"]).withColumn("model_name", F.lit(fc.LINEAR))
    found = fc.roll_forward(states, model, ["series_id"], 12).orderBy("sale_date").collect()

    linear, history, expected = model.stages[-1], list(values), []
    for n in range(12):
        date = START + dt.timedelta(days=60 + n)
        dow = date.weekday()
        row = [dow, int(dow > 4), history[-1], history[-2], history[-7], np.mean(history[-3:]), np.mean(history[-7:])]
        history.append(float(np.dot(row, linear.coefficients.toArray()) + linear.intercept))
        expected.append((date, history[-1]))
    assert [row.sale_date for row in found] == [date for date, _ in expected]
    np.testing.assert_allclose([row.revenue_forecast for row in found], [value for _, value in expected], rtol=1e-9)


def test_forecast_of_one_series(spark):
    daily = days(spark, 60).drop("series_id")
    found = fc.forecast(daily, days=3, forest=SMALL, generated_at=dt.datetime(2026, 7, 4, 1, 2, 3))
    assert found.columns == ["sale_date", "revenue_forecast", "model_name", "generated_at"]
    rows = found.orderBy("sale_date").collect()
    assert [row.sale_date for row in rows] == [START + dt.timedelta(days=60 + n) for n in range(3)]
    assert {row.model_name for row in rows} <= set(fc.CANDIDATES)
    assert rows[0].generated_at == dt.datetime(2026, 7, 4, 1, 2, 3)
    assert all(np.isfinite(row.revenue_forecast) for row in rows)


def test_forecast_of_a_panel_skips_short_series(spark):
    rng = np.random.default_rng(1)
    noisy = [float(v) for v in rng.choice([10.0, 5000.0], 50)]
    panel = days(spark, 50, "a").unionByName(days(spark, 50, "b", noisy)).unionByName(days(spark, 13, "short"))
    found = fc.forecast(panel, ["series_id"], days=2, forest=SMALL)
    counted = {row.series_id: row["count"] for row in found.groupBy("series_id").count().collect()}
    assert counted == {"a": 2, "b": 2}


def test_no_history_no_forecast(spark):
    found = fc.forecast(days(spark, 13).drop("series_id"), forest=SMALL)
    assert found.columns == ["sale_date", "revenue_forecast", "model_name", "generated_at"]
    assert found.isEmpty()


def test_series_without_a_name_is_a_series(spark):
    panel = days(spark, 30, "a").unionByName(days(spark, 30, "x").withColumn("series_id", F.lit(None).cast("string")))
    found = fc.forecast(panel, ["series_id"], days=2, forest=SMALL)
    assert {row.series_id: row["count"] for row in found.groupBy("series_id").count().collect()} == {"a": 2, None: 2}


def test_a_gap_stops_only_its_own_series(spark):
    gap = [100.0 + n for n in range(40)]
    gap[-3] = None
    good, bad, short = days(spark, 40, "good"), days(spark, 40, "bad", gap), days(spark, 5, "short")
    panel = good.unionByName(bad).unionByName(short)
    found = fc.forecast(panel, ["series_id"], days=3, forest=SMALL)
    assert {row.series_id for row in found.collect()} == {"good"} and found.count() == 3
    reasons = {row.series_id: row.reason for row in fc.skipped(panel, ["series_id"]).collect()}
    assert reasons == {"bad": "gap among the last values", "short": "too little history"}


def test_training_tasks_follow_from_the_rows(spark, monkeypatch):
    monkeypatch.setattr(fc, "ROWS_PER_TRAINING_TASK", 10)
    panel = days(spark, 95)
    assert fc.for_training(panel, ["series_id"]).withColumn("part", F.spark_partition_id()).select("part").distinct().count() <= 9
    shapes = [
        sorted((row.part, *row.days) for row in fc.for_training(frame, ["series_id"])
               .withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.collect_list("sale_date").alias("days")).collect())
        for frame in (panel, panel.repartition(13), panel.coalesce(1))
    ]
    assert shapes[0] == shapes[1] == shapes[2]
