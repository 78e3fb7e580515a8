"""Fits from added sums against numpy, and days added to a state against a fit of all rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmart.operators import features, least_squares

START = dt.date(2026, 1, 5)
NAMES = list(features.FEATURES)


def days(spark, counts, level=1e6, seed=3):
    draw = np.random.default_rng(seed)
    rows = [
        (name, START + dt.timedelta(days=n), float(level + 900 * np.sin(n) + 300 * (n % 7) + draw.normal(0, 50)))
        for name, count in counts.items()
        for n in range(count)
    ]
    return spark.createDataFrame(rows, "series_id STRING, sale_date DATE, revenue DOUBLE")


def by_numpy(daily, name):
    rows = features.features(daily, ["series_id"]).toPandas()
    rows = rows[rows.series_id.isna() if name is None else rows.series_id == name]
    x = np.column_stack([np.ones(len(rows)), rows[NAMES].to_numpy(float)])
    return x, np.linalg.lstsq(x - [0, *x[:, 1:].mean(axis=0)], rows.revenue.to_numpy(float), rcond=None)[0], len(rows)


def values(fit, x):
    return fit["intercept"] + x[:, 1:] @ np.array(fit["weights"])


def test_equals_numpy(spark):
    daily = days(spark, {"a": 60, "b": 45, None: 50})
    fits = least_squares.solved(least_squares.started(daily, ["series_id"]), ["series_id"]).collect()
    assert {f.series_id for f in fits} == {"a", "b", None}
    for fit in fits:
        x, expected, rows = by_numpy(daily, fit.series_id)
        assert fit.rows == rows
        centred = x - [0, *x[:, 1:].mean(axis=0)]
        np.testing.assert_allclose(values(fit, x), centred @ expected, rtol=1e-9)
        np.testing.assert_allclose(fit["weights"], expected[1:], rtol=1e-5, atol=1e-6)


@pytest.mark.parametrize("step", [1, 3, 10])
def test_added_days_equal_a_full_fit(spark, step):
    daily = days(spark, {"a": 40, "b": 40}).checkpoint()
    cut = START + dt.timedelta(days=30)
    state = least_squares.started(daily.where(F.col("sale_date") < cut), ["series_id"]).checkpoint()
    for n in range(0, 10, step):
        first = cut + dt.timedelta(days=n)
        new = daily.where((F.col("sale_date") >= first) & (F.col("sale_date") < first + dt.timedelta(days=step)))
        state = least_squares.advanced(state, new, ["series_id"]).checkpoint()
    whole = least_squares.started(daily, ["series_id"])
    for got, wanted in zip(*[sorted(s.drop("origin", "sums").collect()) for s in (state, whole)]):
        assert got == wanted
    found, expected = [{f.series_id: f for f in least_squares.solved(s, ["series_id"]).collect()} for s in (state, whole)]
    for name in "ab":
        x, _, rows = by_numpy(daily, name)
        assert found[name].rows == expected[name].rows == rows
        np.testing.assert_allclose(values(found[name], x), values(expected[name], x), rtol=1e-9)


def test_history_is_not_read(spark):
    """A refit looks at the state and the new days only: the plan reads no other table."""
    daily = days(spark, {"a": 40}).checkpoint()
    state = least_squares.started(daily.where("sale_date < '2026-02-10'"), ["series_id"]).checkpoint()
    new = spark.createDataFrame([("a", dt.date(2026, 2, 14), 1.0)], daily.schema).checkpoint()
    after = least_squares.advanced(state, new, ["series_id"]).first()
    assert after.last_date == dt.date(2026, 2, 14) and after.recent[-1] == 1.0 and len(after.recent) == 7


def test_parts_in_any_cut(spark):
    """Sums of any cut of the rows add up to the sums of all, for all groups together too."""
    rows = features.features(days(spark, {"a": 60, "b": 45}), ["series_id"]).checkpoint()
    zero = least_squares.origins(rows).checkpoint()
    parts = [least_squares.moments(rows.where(f"pmod(xxhash64(sale_date), 3) = {n}"), [], zero) for n in range(3)]
    found = least_squares.merged(parts).first().sums
    np.testing.assert_allclose(found, least_squares.moments(rows, [], zero).first().sums, rtol=1e-12, atol=1e-6)
    fit = least_squares.solved(least_squares.merged(parts)).first()
    frame = rows.toPandas()
    x = np.column_stack([np.ones(len(frame)), frame[NAMES].to_numpy(float)])
    centred = x - [0, *x[:, 1:].mean(axis=0)]
    np.testing.assert_allclose(values(fit, x), centred @ np.linalg.lstsq(centred, frame.revenue.to_numpy(), rcond=None)[0], rtol=1e-9)


def test_different_origins_are_refused(spark):
    rows = features.features(days(spark, {"a": 30}), ["series_id"])
    one = least_squares.moments(rows, [], least_squares.origins(rows))
    other = one.withColumn("origin", F.transform("origin", lambda x: x + 1))
    with pytest.raises(Exception, match="different origins"):
        least_squares.merged([one, other]).collect()


def test_redundant_features_and_odd_rows(spark):
    """A feature that is constant or follows from another gets the weight 0; unusable rows count nowhere; no rows, no fit."""
    nan, inf = float("nan"), float("inf")
    rows = [(float(n), 2.0 * n, 7.0, 3.0 * n + 1) for n in range(20)] + [(nan, 1.0, 7.0, 1.0), (1.0, inf, 7.0, 1.0), (None, 1.0, 7.0, 1.0), (1.0, 2.0, 7.0, None)]
    frame = spark.createDataFrame(rows, "x double, y double, z double, revenue double")
    names = ["x", "y", "z"]
    fit = least_squares.solved(least_squares.moments(frame, [], least_squares.origins(frame, [], names), names), [], names).first()
    assert fit.rows == 20 and fit["weights"] == pytest.approx([3, 0, 0]) and fit.intercept == pytest.approx(1)
    empty = frame.limit(0)
    assert least_squares.merged([least_squares.moments(empty, [], least_squares.origins(empty, [], names), names)], [], names).collect() == []
    assert least_squares.started(days(spark, {"a": 5}), ["series_id"]).collect() == []
