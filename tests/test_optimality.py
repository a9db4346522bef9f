"""Fitted ridge models against their slopes, contributions against brute force over all orders, the holiday calendar."""

import datetime as dt
from itertools import permutations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from airloom.models import explain, ridge
from airloom.plans import training as T


class Product:
    """A model with an interaction, so that the order of the features matters."""

    def __init__(self):
        self.scored = 0

    def transform(self, df):
        x = vector_to_array("features")
        return df.withColumn("prediction", F.get(x, F.lit(0)) * F.get(x, F.lit(1)) + F.get(x, F.lit(2)) ** 2)


def plain_prediction(x):
    return x[0] * x[1] + x[2] ** 2


def plain_shapley(value, base):
    total = np.zeros(3)
    orders = list(permutations(range(3)))
    for order in orders:
        now = list(base)
        for f in order:
            before = plain_prediction(now)
            now[f] = value[f]
            total[f] += plain_prediction(now) - before
    return total / len(orders)


@pytest.fixture(scope="module")
def stations(spark):
    rng = np.random.default_rng(3)
    values = {s: rng.normal(size=3).tolist() for s in (1, 2)}
    bases = {1: rng.normal(size=(40, 3)).tolist(), 2: [[0.5, 0.25, 2.0]] * 40}  # the second always draws the same row
    instances = spark.createDataFrame([(s, *v) for s, v in values.items()], "station long, a double, b double, c double")
    back = spark.createDataFrame(
        [(s, i, b) for s, rows in bases.items() for i, b in enumerate(rows)], "station long, draw int, _base array<double>")
    return instances, back, values, bases


def test_contributions_add_up_and_are_those_of_all_orders(spark, stations):
    instances, back, values, bases = stations
    got = explain.shapley_within(instances, back, Product(), ["a", "b", "c"], -1.0, first=8).collect()
    assert {(r.station, r.draws) for r in got} == {(1, 40), (2, 40)}
    for s in values:
        rows = {r.feature: r for r in got if r.station == s}
        base = np.mean([plain_prediction(b) for b in bases[s]])
        assert rows["a"].base == pytest.approx(base)
        assert base + sum(r.contribution for r in rows.values()) == pytest.approx(plain_prediction(values[s]))
        # a pair of an order and its reverse gives an interaction of two features its exact value
        want = np.mean([plain_shapley(values[s], b) for b in bases[s]], axis=0)
        assert [rows[f].contribution for f in "abc"] == pytest.approx(want.tolist())


def test_draws_stop_within_the_tolerance(spark, stations):
    instances, back, values, _ = stations
    got = explain.shapley_within(instances, back, Product(), ["a", "b", "c"], 1e-9, first=8).collect()
    draws = {r.station: r.draws for r in got}
    assert draws == {1: 40, 2: 8}  # the second station's draws are all alike
    assert all(r.standard_error < 1e-9 for r in got if r.station == 2)
    loose = explain.shapley_within(instances, back, Product(), ["a", "b", "c"], 100.0, first=8)
    assert {r.draws for r in loose.collect()} == {8}


def test_no_background_no_rows(spark, stations):
    instances, back, _, _ = stations
    assert explain.shapley_within(instances, back.where("false"), Product(), ["a", "b", "c"], 1.0).count() == 0
    one = explain.shapley_within(instances.select("station", "c"), back.select("station", "draw", F.slice("_base", 3, 1).alias("_base")),
                                 Square(), ["c"], 0.0).where("station = 2").first()
    assert one.base + one.contribution == pytest.approx(one.prediction)


class Square:
    def transform(self, df):
        return df.withColumn("prediction", F.get(vector_to_array("features"), F.lit(0)) ** 2)


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = x @ [2.0, -1.0, 0.5] + rng.normal(size=400)
    rows = [(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), *map(float, x[i]), float(y[i]), 0.3 if i < 100 else 1.0) for i in range(400)]
    rows[7] = (*rows[7][:3], None, *rows[7][4:])
    df = spark.createDataFrame(
        rows, "station long, datetime timestamp_ntz, a double, b double, c double, target_us_aqi_24h_ahead double, weight double")
    return T.pooled_cv_blocks(df)


def test_slopes_are_zero_only_at_the_minimum(spark, train):
    names = ["a", "b", "c"]
    models, stats = ridge.fit_ridge(train, names, (24,), weight=F.col("weight"))
    fitted = models.first()
    slopes = ridge.optimality(train, models, stats, names, weight=F.col("weight")).collect()
    assert [r.feature for r in slopes] == ["intercept", *names] and {r.rows for r in slopes} == {399}
    assert max(r.gradient for r in slopes) < 1e-9
    moved = spark.createDataFrame([fitted], ridge.MODEL_SCHEMA).withColumn(
        "coefficients", F.transform("coefficients", lambda v: v * 1.01))
    assert max(r.gradient for r in ridge.optimality(train, moved, stats, names, weight=F.col("weight")).collect()) > 1e-4
    # another weight has another minimum
    assert max(r.gradient for r in ridge.optimality(train, models, stats, names).collect()) > 1e-4


def test_features_of_a_horizon(spark, train):
    models, stats = ridge.fit_ridge(train, ["a", "b", "c"], (24,), used={24: ["c", "a"]})
    slopes = ridge.optimality(train, models, stats, ["a", "b", "c"], {24: ["c", "a"]}).collect()
    assert [r.feature for r in slopes] == ["intercept", "c", "a"] and {r.rows for r in slopes} == {400}
    assert max(r.gradient for r in slopes) < 1e-9


def test_lunar_days_in_sql_are_those_of_the_calendar(spark):
    import duckdb

    from airloom.sources.holidays import holiday_calendar
    from airloom.workload.features import LUNAR_SQL
    both = {r.holiday_date for r in holiday_calendar(spark, 1990, 2030).collect()}
    civil = {r.holiday_date for r in holiday_calendar(spark, 1990, 2030, lunar=False).collect()}
    days = {d for (d,) in duckdb.sql(f"SELECT DISTINCT day FROM ({LUNAR_SQL}) AS l(day) WHERE year(day) BETWEEN 1990 AND 2030").fetchall()}
    assert both - civil <= days <= both
