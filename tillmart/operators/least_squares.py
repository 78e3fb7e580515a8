"""Linear regressions that are kept up to date: sums of products per group, which add up over days, batches and places.

The sums of a group are those of the products of each pair of (1, features, target), all less a fixed origin of the group, so that
no precision is lost where values are large and vary little. They are as many as the pairs of columns, whatever the number of rows;
a refit adds the sums of the new rows and reads no old ones. The equations are solved by Cholesky in column expressions, one stage
per feature, for all groups in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.operators.features import FEATURES, is_complete, last_values, with_features

TARGET = "revenue"
# A feature of which so little is left beside the earlier ones follows from them; it gets the weight 0.
REDUNDANT = 1e-11


def _pairs(size: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(size) for j in range(i + 1)]


def origins(rows: DataFrame, by: Sequence[str] = (), features: Sequence[str] = FEATURES) -> DataFrame:
    """(by, origin): the values of one row per group, whichever has the smallest ones. It is kept with the group's sums from then on."""
    return _usable(rows, features).groupBy(*by).agg(F.min(_values(features)).alias("origin"))


def moments(rows: DataFrame, by: Sequence[str], origin: DataFrame, features: Sequence[str] = FEATURES, within: Sequence[str] | None = None) -> DataFrame:
    """(by, origin, sums) of the rows, with the ``origin`` of each group of ``within`` (by default of ``by``).

    Rows with a null or non-finite value in a feature or the target take no part. A group that has no origin yet has none of its rows
    counted: give all groups one, by :func:`origins` over old and new rows.
    """
    known = by if within is None else within
    size = len(features) + 2
    joined = _joined(_usable(rows, features), origin, known, "origin")
    shifted = joined.withColumn("shifted", F.zip_with(_values(features), "origin", lambda value, zero: value - zero))
    value = [F.lit(1.0), *[F.col("shifted")[n] for n in range(size - 1)]]
    sums = [F.sum(value[i] * value[j]) for i, j in _pairs(size)]
    return shifted.groupBy(*by, "origin").agg(F.array(*sums).alias("sums")).select(*by, "origin", "sums")


def merged(parts: Sequence[DataFrame], by: Sequence[str] = (), features: Sequence[str] = FEATURES) -> DataFrame:
    """The sums of several parts of the same groups. Parts with different origins cannot be added and make the job fail."""
    every = reduce(DataFrame.unionByName, [part.select(*by, "origin", "sums") for part in parts])
    count = len(_pairs(len(features) + 2))
    added = every.groupBy(*by).agg(
        F.min("origin").alias("origin"), F.max("origin").alias("other"), F.array(*[F.sum(F.col("sums")[n]) for n in range(count)]).alias("sums")
    )
    differ = F.raise_error(F.lit("Sums of products with different origins cannot be added."))
    # a group without any part has no row but where there is one group only
    return added.where("origin is not null").withColumn("origin", F.when(F.col("origin") == F.col("other"), F.col("origin")).otherwise(differ)).drop("other")


def solved(sums: DataFrame, by: Sequence[str] = (), features: Sequence[str] = FEATURES) -> DataFrame:
    """(by, rows, intercept, weights): the least-squares fit of each group; ``weights`` in the order of the features."""
    size = len(features)
    place = {pair: n for n, pair in enumerate(_pairs(size + 2))}
    total = lambda i, j: F.col("sums")[place[max(i, j), min(i, j)]]
    kept = [*by, "origin", "sums"]

    # products of deviations from the mean; the target comes last
    def deviation(i: int, j: int) -> Column:
        return total(i + 1, j + 1) - total(i + 1, 0) * total(j + 1, 0) / total(0, 0)

    state = sums.select(*kept, *[deviation(i, j).alias(f"_c_{i}_{j}") for i, j in _pairs(size + 1)])
    for j in range(size):
        own = F.col(f"_c_{j}_{j}") - _sum(F.col(f"_l_{j}_{m}") * F.col(f"_l_{j}_{m}") for m in range(j))
        state = state.withColumn(f"_own_{j}", own)
        left = F.col(f"_own_{j}")
        state = state.withColumn(f"_inverse_{j}", F.when(left > REDUNDANT * F.col(f"_c_{j}_{j}"), 1 / F.sqrt(left)).otherwise(0.0))
        below = {
            f"_l_{i}_{j}": (F.col(f"_c_{i}_{j}") - _sum(F.col(f"_l_{i}_{m}") * F.col(f"_l_{j}_{m}") for m in range(j))) * F.col(f"_inverse_{j}")
            for i in range(j + 1, size + 1)
        }
        state = state.withColumns(below)
    for j in reversed(range(size)):
        rest = _sum(F.col(f"_l_{i}_{j}") * F.col(f"_w_{i}") for i in range(j + 1, size))
        state = state.withColumn(f"_w_{j}", (F.col(f"_l_{size}_{j}") - rest) * F.col(f"_inverse_{j}"))
    mean = [F.col("origin")[i] + total(i + 1, 0) / total(0, 0) for i in range(size + 1)]
    intercept = mean[size] - _sum(F.col(f"_w_{i}") * mean[i] for i in range(size))
    weights = F.array(*[F.col(f"_w_{i}") for i in range(size)])
    return state.select(*by, total(0, 0).cast("bigint").alias("rows"), intercept.alias("intercept"), weights.alias("weights"))


def predicted(rows: DataFrame, fit: DataFrame, by: Sequence[str] = (), features: Sequence[str] = FEATURES) -> DataFrame:
    """The rows of groups that have a fit, with its ``prediction``."""
    joined = _joined(rows, fit, by, "intercept", "weights")
    value = F.col("intercept") + _sum(F.col("weights")[n] * F.col(name) for n, name in enumerate(features))
    return joined.withColumn("prediction", value).drop("intercept", "weights")


def started(daily: DataFrame, series: Sequence[str]) -> DataFrame:
    """The state of a fit per series: (series, last_date, recent, origin, sums), a row for each series that has a complete row."""
    rows = with_features(daily.select(*series, "sale_date", "revenue"), series).where(is_complete())
    sums = moments(rows, series, origins(rows, series))
    return _joined(last_values(daily, series), sums, series, "origin", "sums")


def advanced(state: DataFrame, days: DataFrame, series: Sequence[str]) -> DataFrame:
    """The state after ``days``, all later than what it holds; older days are not read, as it carries the last seven values.

    Series that the state lacks are left out: start them by :func:`started` from their days so far.
    """
    before = state.select(*series, "last_date", F.posexplode("recent").alias("place", "revenue"), F.size("recent").alias("held"))
    # their dates only have to come before the new ones, in order
    old = before.select(*series, F.expr("date_sub(last_date, held - place - 1)").alias("sale_date"), "revenue", F.lit(False).alias("is_new"))
    new = days.select(*series, "sale_date", "revenue", F.lit(True).alias("is_new"))
    rows = old.unionByName(new)
    complete = with_features(rows, series).where(F.col("is_new") & is_complete())
    added = moments(complete, series, state.select(*series, "origin"))
    recent = last_values(rows.drop("is_new"), series)
    sums = merged([state, added], series)
    return _joined(recent, sums, series, "origin", "sums")


def _sum(terms) -> Column:
    return reduce(add, terms, F.lit(0.0))


def _values(features: Sequence[str]) -> Column:
    return F.array(*[F.col(name).cast("double") for name in [*features, TARGET]])


def _usable(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    infinite = F.lit(float("inf"))
    return rows.where(F.forall(_values(features), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)))


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str], *columns: str) -> DataFrame:
    """Join on the groups, a null being a group like any other. Without groups ``right`` has at most one row, whose values are looked up."""
    if not by:
        found = left.withColumns({name: right.select(name).scalar() for name in columns})
        return found.where(reduce(and_, [F.col(name).isNotNull() for name in columns]))
    renamed = right.select(*[F.col(name).alias(f"_of_{name}") for name in by], *columns)
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by])
    return left.join(renamed, same).drop(*[f"_of_{name}" for name in by])
