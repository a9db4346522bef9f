"""Golden cases of scalars, categories, requests, splits and folds."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.functions import aqi
from airloom.functions import scalars as S
from airloom.operators.metrics import regression_metrics, scaler_stats
from airloom.operators.quantiles import exact_quantiles
from airloom.plans.features import feature_plan
from airloom.plans.training import add_split, cv_blocks, order_violations
from airloom.schema import AIR_QUALITY_VARS, POINT_COLUMNS, WEATHER_VARS
from airloom.sources import landing, requests
from airloom.sources.holidays import holiday_calendar


def one(spark, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row


@pytest.mark.parametrize("value, category", [
    (50.0, "Good"), (51.0, "Moderate"), (50.5, "Hazardous"), (150.4, "Hazardous"), (200.9, "Hazardous"),
    (-1.0, "Hazardous"), (600.0, "Hazardous"), (None, "Unknown"), (float("nan"), "Unknown"),
])
def test_classify(spark, value, category):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(aqi.classify(F.col("v"))["category"]).first()[0] == category


def test_classify_contiguous(spark):
    df = spark.createDataFrame([(v,) for v in (50.5, 150.4, 200.9, -1.0)], "v double")
    got = [r[0] for r in df.select(aqi.classify(F.col("v"), "contiguous")["category"]).collect()]
    assert got == ["Moderate", "Unhealthy", "Very Unhealthy", "Good"]


def test_alerts(spark):
    df = spark.createDataFrame([(24, 149.9), (24, 150.0), (48, 199.9), (72, 200.0), (72, None)],
                               "horizon_hours int, predicted_aqi double")
    rows = aqi.alerts(df).orderBy("value").collect()
    assert [(r.horizon, r.severity, r.value) for r in rows] == [
        ("24h", "warning", 150.0), ("48h", "warning", 199.9), ("72h", "severe", 200.0)]
    assert rows[0].message.startswith("Warning: AQI forecast for 24h is 150.0 (Unhealthy for Sensitive Groups). ")


@pytest.mark.parametrize("direction, blend", [(45.0, 149.999894), (0.0, 99.999900), (None, None)])
def test_upwind(spark, direction, blend):
    df = spark.createDataFrame([(direction, 100.0, 200.0, 7.0, 9.0)],
                               "d double, us_aqi_dir_N double, us_aqi_dir_E double, us_aqi_dir_S double, us_aqi_dir_W double")
    got = df.select(S.upwind_blend("us_aqi", F.col("d"))).first()[0]
    assert got == (None if blend is None else pytest.approx(blend, abs=1e-6))


@pytest.mark.parametrize("bearing, point", [
    (0.0, (25.310461, 67.0104)), (90.0, (24.859982, 67.505984)), (180.0, (24.411139, 67.0104)), (270.0, (24.859982, 66.514816))])
def test_destination(spark, bearing, point):
    row = one(spark, lat=24.8608, lon=67.0104, b=bearing)
    got = row.select(*S.destination(F.col("lat"), F.col("lon"), F.col("b"), 50.0)).first()
    assert tuple(got) == pytest.approx(point, abs=1e-6)


def test_date_chunks(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 12, 31))], "station long, start_date date, end_date date")
    rows = requests.date_chunks(df).orderBy("chunk_start").collect()
    assert [(r.chunk_start.month, r.chunk_start.day) for r in rows] == [(1, 1), (3, 31), (6, 29), (9, 27), (12, 26)]
    assert rows[-1].chunk_end == dt.date(2024, 12, 31)
    assert all(a.chunk_end + dt.timedelta(1) == b.chunk_start for a, b in zip(rows, rows[1:], strict=False))


def test_split_start_clamps_leap_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 5),), (dt.datetime(2023, 2, 28, 6),), (dt.datetime(2023, 2, 28, 5),)],
                               "datetime timestamp_ntz")
    got = {r.datetime: r.split for r in add_split(df).collect()}
    assert got[dt.datetime(2023, 2, 28, 6)] == "test" and got[dt.datetime(2023, 2, 28, 5)] == "train"


@pytest.mark.parametrize("n, sizes", [(10, [4, 2, 2, 2]), (103, [28, 25, 25, 25]), (694, [175, 173, 173, 173])])
def test_cv_blocks(series, station_kind, n, sizes):
    counts = cv_blocks(series([0.0] * n)).groupBy("cv_block").count().orderBy("cv_block").collect()
    assert [r["count"] for r in counts] == sizes


def test_order_violations_across_chunks(spark):
    rows = [(1, i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for i, h in enumerate([0, 1, 5, 3, 4, 2, 6])]
    df = spark.createDataFrame(rows, "station long, seq long, datetime timestamp_ntz")
    for chunk_rows in (1, 2, 3, 100):
        assert order_violations(df, "seq", chunk_rows).first().out_of_order == 2


def test_quantiles_of_skewed_copies(spark):
    values = [0.0] * 500 + [float(i) ** 3 for i in range(777)] + [1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, [], "v", [0.0, 0.25, 0.5, 0.9, 1.0], accuracy=100).first().quantiles
    assert got == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0])))


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    row = regression_metrics(df, "y", "p").first()
    assert row.rmse == pytest.approx((2 / 3) ** 0.5) and row.mae == pytest.approx(2 / 3)
    assert row.r2 == pytest.approx(1 - 2 / (14 / 3))
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert regression_metrics(constant, "y", "p").first().r2 is None


def test_scaler_of_constant_column(spark):
    row = scaler_stats(spark.createDataFrame([(3.0, 1.0), (3.0, 3.0)], "a double, b double"), ["a", "b"]).first()
    assert row["mean"] == {"a": 3.0, "b": 2.0} and row["std"] == {"a": 1.0, "b": 1.0}


def test_holidays(spark):
    dates = {r.holiday_date for r in holiday_calendar(spark, 2024, 2024).collect()}
    assert dt.date(2024, 3, 23) in dates and dt.date(2024, 8, 14) in dates
    # the estimated lunar dates lie within a day of the observed ones
    assert any(abs((d - dt.date(2024, 4, 10)).days) <= 1 for d in dates)
    assert any(abs((d - dt.date(2024, 6, 17)).days) <= 1 for d in dates)


def test_payload_round_trip(spark, series, tmp_path):
    df = series([1.0, None, 3.0])
    landing.to_payloads(df, ["us_aqi"]).write.json(str(tmp_path / "p"))
    got = landing.read_payloads(spark, str(tmp_path / "p"), ["us_aqi"])
    assert sorted(got.collect(), key=lambda r: r.datetime) == sorted(df.collect(), key=lambda r: r.datetime)


def full_frame(spark, points):
    columns = WEATHER_VARS + AIR_QUALITY_VARS + (POINT_COLUMNS if points else [])
    return spark.range(300).selectExpr(
        "1L AS station", "TIMESTAMP_NTZ'2024-01-01' + make_interval(0,0,0,0,cast(id as int)) AS datetime",
        *[f"rand({i}) * 100 AS {c}" for i, c in enumerate(columns)])


@pytest.mark.parametrize("points, width", [(True, 84), (False, 74)])
def test_feature_schema(spark, points, width):
    df = feature_plan(full_frame(spark, points), holiday_calendar(spark, 2024, 2024))
    assert len(df.columns) == width + 1  # and the station
    types = dict(df.dtypes)
    assert types["day"] == "int" and types["is_weekend"] == "int" and types["aqi_lag_6h"] == "double"
