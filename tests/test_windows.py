"""Golden cases and pandas semantics of cleaning and window features."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from airloom.operators import windows as X
from airloom.operators.clean import clean, deduplicate, missing_hours, nan_to_null
from airloom.operators.skew import over_station, with_position


def column(df, name):
    return [r[name] for r in df.orderBy("station", "datetime").collect()]


def close(got, want, tolerance=1e-9):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None
        else:
            assert g == pytest.approx(w, abs=tolerance)


def test_interpolate_and_clip(series, station_kind):
    df = series([None, 2.0, None, None, 8.0, -3.0, None])
    close(column(clean(df), "us_aqi"), [2, 2, 4, 6, 8, 0, 0])


def test_interpolation_crosses_empty_hours_of_a_hot_station(series, station_kind):
    values = [None] * 50 + [10.0] + [None] * 99 + [110.0] + [None] * 60
    want = pd.Series(values, dtype=float).interpolate(method="linear", limit_direction="both")
    close(column(clean(series(values)), "us_aqi"), list(want))


def test_all_missing_stays_missing(series, station_kind):
    close(column(clean(series([None] * 60)), "us_aqi"), [None] * 60)


def test_imputed_flag(series, station_kind):
    df = clean(series([None, 2.0, None, 4.0]), flag_imputed=True)
    assert column(df, "was_imputed") == [True, False, True, False]


@pytest.mark.parametrize("rows", [10, 24, 150, 400])
def test_features_equal_pandas(spark, series, station_kind, rows):
    random.seed(rows)
    values = [round(random.uniform(0, 300), 2) for _ in range(rows)]
    df = series(values)
    got = X.rolling(df, lambda w: [*X.aqi_lags(w), *X.aqi_day_frame(w), X.acceleration(w), *X.targets(w)],
                    ("aqi_rolling_mean_24h", "aqi_rolling_mean_72h", "aqi_rolling_mean_168h"))
    s = pd.Series(values)
    want = {
        "aqi_lag_6h": s.shift(6), "aqi_lag_72h": s.shift(72), "aqi_rolling_std_24h": s.rolling(24).std(),
        "aqi_rolling_max_24h": s.rolling(24).max(), "aqi_rolling_mean_24h": s.rolling(24).mean(),
        "aqi_rolling_mean_72h": s.rolling(72).mean(), "aqi_rolling_mean_168h": s.rolling(168).mean(),
        "aqi_acceleration_1h": s.diff().diff(), "target_us_aqi_48h_ahead": s.shift(-48),
    }
    pdf = got.orderBy("datetime").toPandas()
    for name, expected in want.items():
        pd.testing.assert_series_equal(pdf[name], expected, check_names=False, atol=1e-8, rtol=0)


def test_null_inside_a_frame_gives_null(series):
    values = [float(i) for i in range(30)]
    values[26] = None
    df = X.rolling(series(values), long_names=("aqi_rolling_mean_24h",))
    got = column(df, "aqi_rolling_mean_24h")
    assert got[25] == pytest.approx(13.5) and got[26] is None and got[29] is None


def test_a_second_station_changes_nothing(series, station_kind):
    one = series([float(i % 7) for i in range(100)])
    both = one.unionByName(series([None, 5.0, None] * 60, station=2))
    alone, together = clean(one), clean(both)
    assert column(alone, "us_aqi") == column(together.filter("station = 1"), "us_aqi")


def test_targets_are_later_readings(series, station_kind):
    df = X.rolling(series([float(i * i % 97) for i in range(120)]), X.targets)
    rows = df.orderBy("datetime").collect()
    for h in (24, 48, 72):
        for i in range(120 - h):
            assert rows[i][f"target_us_aqi_{h}h_ahead"] == rows[i + h].us_aqi


def test_no_feature_looks_ahead(series):
    values = [float(i * 13 % 101) for i in range(200)]
    changed = [*values[:150], *[v + 50 for v in values[150:]]]
    features = ["aqi_lag_24h", "aqi_rolling_std_24h", "aqi_rolling_mean_168h"]
    frames = [
        X.rolling(clean(series(v)), lambda w: [*X.aqi_lags(w), *X.aqi_day_frame(w)], ("aqi_rolling_mean_168h",))
        .orderBy("datetime").limit(150).select(*features).collect() for v in (values, changed)]
    assert frames[0] == frames[1]


def test_deduplicate_keeps_first_and_last(spark, series):
    df = series([1.0, 2.0]).withColumn("seq", F.lit(0)).unionByName(
        series([3.0, 4.0]).withColumn("seq", F.lit(1)))
    assert column(deduplicate(df, "seq"), "us_aqi") == [1.0, 2.0]
    assert column(deduplicate(df, "seq", keep="last"), "us_aqi") == [3.0, 4.0]


def test_clean_drops_copies(series, station_kind):
    df = series([1.0, None, 3.0])
    for _ in range(5):
        df = df.unionByName(df)
    close(column(clean(df.withColumn("seq", F.monotonically_increasing_id()), ["us_aqi"], "seq"), "us_aqi"), [1, 2, 3])


def test_nan_becomes_null(series):
    df = nan_to_null(series([float("nan"), 200.0]))
    assert column(df, "us_aqi") == [None, 200.0]
    assert df.filter("us_aqi > 150").count() == 1


def test_missing_hours(series, station_kind):
    df = series([float(i) for i in range(10)]).filter(~F.hour("datetime").isin(3, 4, 7))
    assert [r.datetime.hour for r in missing_hours(df).orderBy("datetime").collect()] == [3, 4, 7]


def test_positions(series, station_kind):
    df = with_position(series([0.0] * 130).unionByName(series([0.0] * 20, station=2)))
    got = [(r.station, r._pos) for r in df.orderBy("station", "datetime").collect()]
    assert got == [(1, i) for i in range(130)] + [(2, i) for i in range(20)]


def test_blocks_return_every_row_once(series, station_kind):
    df = series([float(i) for i in range(333)])
    out = over_station(df, lambda d, keys: d.withColumn("x", F.lag("us_aqi", 100).over(X.by_time(keys))), before=100)
    assert column(out, "x") == [None] * 100 + [float(i) for i in range(233)]


# --- plan shape ----------------------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_and_features_need_one_exchange_and_one_sort(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(2000).selectExpr(
        "id % 10 AS station", "TIMESTAMP_NTZ'2024-01-01' + make_interval(0,0,0,0,cast(id div 10 as int)) AS datetime",
        "rand(1) AS us_aqi", "rand(2) AS pm2_5", "rand(3) AS pm10").write.parquet(path)
    df = X.rolling(clean(spark.read.parquet(path), ["us_aqi", "pm2_5", "pm10"]), X.aqi_lags,
                   ("aqi_rolling_mean_168h", "pm2_5_rolling_mean_48h", "pm10_rolling_mean_72h"))
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "SinglePartition" not in plan and "Python" not in plan


def test_deduplicate_limits_before_the_shuffle(series):
    plan = plan_of(deduplicate(series([1.0]).withColumn("seq", F.lit(1)), "seq"))
    assert "WindowGroupLimit" in plan and "Partial" in plan
