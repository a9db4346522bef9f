"""Late rows, folds over all stations, features of a horizon, skipped stations, calendar limits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airloom.models import ridge
from airloom.plans import forecast as P
from airloom.plans.training import cv_blocks, pooled_cv_blocks
from airloom.schema import TARGETS
from airloom.session import new_path
from airloom.sources import store
from airloom.sources.holidays import flag_holidays, holiday_calendar, holidays_of
from airloom.streaming import incremental

START = dt.datetime(2024, 1, 1)


def rows_of(spark, hours, station=1):
    data = [(station, START + dt.timedelta(hours=h), float(h * 7 % 31)) for h in hours]
    return spark.createDataFrame(data, "station bigint, datetime timestamp_ntz, us_aqi double")


def plan(raw, holidays, seq=None):
    from pyspark.sql import Window
    w = Window.partitionBy("station").orderBy("datetime")
    return raw.withColumns({"before": F.lag("us_aqi", 100).over(w), "target": F.lead("us_aqi", 72).over(w)})


def content(df):
    return sorted(map(tuple, df.select("station", "datetime", "us_aqi", "before", "target").collect()), key=str)


@pytest.mark.parametrize("late", [range(200, 212), range(30, 33)])
def test_late_rows_reach_the_table(spark, late):
    path = new_path(spark, "late")
    everything = rows_of(spark, range(600))
    store.rebuild(plan(rows_of(spark, [h for h in range(600) if h not in late]), None), path, buckets=2)
    incremental.refresh(everything, path, None, plan=plan)
    assert content(store.read_table(spark, path)) == content(plan(everything, None))


def test_corrected_rows_move_the_start_back(spark):
    path = new_path(spark, "corrected")
    old = rows_of(spark, range(400)).unionByName(rows_of(spark, range(40), station=2))
    new = old.withColumn("us_aqi", F.when((F.col("station") == 1) & (F.hour("datetime") == 5)
                                          & (F.to_date("datetime") == "2024-01-09"), 500.0).otherwise(F.col("us_aqi")))
    store.rebuild(plan(old, None), path, buckets=2)
    oldest = spark.createDataFrame([(1, dt.datetime(2024, 1, 9, 5))], "station bigint, oldest timestamp_ntz")
    incremental.refresh(new, path, None, plan=plan, oldest=oldest)
    assert content(store.read_table(spark, path)) == content(plan(new, None))


def test_targets_of_a_short_station_are_completed(spark):
    path = new_path(spark, "short")
    store.rebuild(plan(rows_of(spark, range(10)), None), path, buckets=2)
    incremental.refresh(rows_of(spark, range(90)), path, None, plan=plan)
    assert content(store.read_table(spark, path)) == content(plan(rows_of(spark, range(90)), None))


def test_pooled_folds_never_train_on_later_rows(spark):
    df = rows_of(spark, range(300)).unionByName(rows_of(spark, range(250, 500), station=2))
    spans = {r.cv_block: r for r in pooled_cv_blocks(df).groupBy("cv_block").agg(
        F.min("datetime").alias("first"), F.max("datetime").alias("last"), F.count("*").alias("n")).collect()}
    assert sorted(spans) == [0, 1, 2, 3] and sum(r.n for r in spans.values()) == 550
    for i in range(3):
        assert spans[i].last < spans[i + 1].first


@pytest.mark.parametrize("n", [3, 10, 103])
def test_pooled_folds_of_one_station(spark, n):
    df = rows_of(spark, range(n))
    got = {r.datetime: r.cv_block for r in pooled_cv_blocks(df).collect()}
    assert got == {r.datetime: r.cv_block for r in cv_blocks(df).collect()}


def test_pooled_folds_of_no_rows(spark):
    assert pooled_cv_blocks(rows_of(spark, [])).count() == 0


def labelled(spark):
    df = rows_of(spark, range(200)).withColumn("wind_future_48h", (F.hour("datetime") * 3 % 7).cast("double"))
    return df.withColumns({t: F.col("us_aqi") * (i + 1) + F.col("wind_future_48h") for i, t in enumerate(TARGETS)})


def test_a_horizon_gets_its_own_features(spark):
    blocks = pooled_cv_blocks(labelled(spark))
    used = {24: ["us_aqi"], 48: ["us_aqi", "wind_future_48h"], 72: ["us_aqi"]}
    models, _ = ridge.fit_ridge(blocks, ["us_aqi", "wind_future_48h"], used=used)
    alone, _ = ridge.fit_ridge(blocks, ["us_aqi"])
    got, want = ({m.horizon: m for m in x.collect()} for x in (models, alone))
    assert {h: len(m.coefficients) for h, m in got.items()} == {24: 1, 48: 2, 72: 1}
    for h in (24, 72):
        assert got[h].coefficients == pytest.approx(want[h].coefficients)
        assert (got[h].alpha, got[h].cv_rmse) == pytest.approx((want[h].alpha, want[h].cv_rmse))


def test_a_missing_reading_costs_only_the_horizons_that_use_it(spark):
    blocks = pooled_cv_blocks(labelled(spark)).cache()
    odd = F.dayofmonth("datetime") == 3
    holes = blocks.withColumns({c: F.when(~odd, F.col(c)) for c in ("wind_future_48h", TARGETS[2])})
    used = {24: ["us_aqi"], 48: ["us_aqi", "wind_future_48h"], 72: ["us_aqi"]}
    lost = blocks.filter(odd).count()
    got = {m.horizon: m for m in ridge.fit_ridge(holes, ["us_aqi", "wind_future_48h"], used=used)[0].collect()}
    want = {m.horizon: m for m in ridge.fit_ridge(blocks, ["us_aqi"])[0].collect()}
    assert lost > 0 and {h: m.left_out for h, m in got.items()} == {24: 0, 48: lost, 72: lost}
    assert got[24].coefficients == pytest.approx(want[24].coefficients) and got[24].cv_rmse == pytest.approx(want[24].cv_rmse)


def test_rows_left_out_of_a_fit_are_counted(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), 2.0), (3.0, 4.0)], "a double, b double")
    assert {r.column: r.rows for r in ridge.left_out(df, ["a", "b"]).collect()} == {"a": 2, "b": 2, None: 3}


def test_skipped_stations_are_named(spark):
    table = rows_of(spark, [1, 2]).unionByName(
        rows_of(spark, [3], station=2).withColumn("us_aqi", F.lit(None).cast("double")))
    bundle = P.Bundle(24, "same", ["us_aqi"], lambda rows: rows.withColumn("prediction", F.col("us_aqi")))
    rows, skipped = P.forecast_and_skipped(table, [bundle])
    assert [r.station for r in rows.collect()] == [1]
    assert [(r.station, r.horizon_hours, r.missing_features) for r in skipped.collect()] == [(2, 24, ["us_aqi"])]


def test_dates_outside_the_calendar_raise(spark):
    df = rows_of(spark, [0])
    assert flag_holidays(df, holidays_of(df)).first().is_public_holiday == 0
    with pytest.raises(Exception, match="no holiday calendar for the year 2024"):
        flag_holidays(df, holiday_calendar(spark, 2020, 2023)).collect()
    assert flag_holidays(df.filter("false"), holidays_of(df.filter("false"))).count() == 0


def test_years_without_a_holiday(spark):
    days = {r.holiday_date for r in holiday_calendar(spark, 2014, 2022, lunar=False).collect()}
    assert [y for y in range(2014, 2023) if dt.date(y, 11, 9) in days] == [2014, 2022]


def test_new_rows_without_warm_up_are_not_stored(spark):
    def warm_plan(raw, holidays, seq=None):
        return plan(raw, holidays).withColumn("aqi_rolling_mean_168h", F.col("before"))

    path = new_path(spark, "warm")
    store.rebuild(warm_plan(rows_of(spark, range(130)), None), path, buckets=2)  # a backfill keeps them
    everything = rows_of(spark, range(150)).unionByName(rows_of(spark, range(120), station=2))
    incremental.refresh(everything, path, None, plan=warm_plan)
    want = plan(everything, None).filter((F.col("station") == 1) | F.col("before").isNotNull())
    assert content(store.read_table(spark, path)) == content(want)
