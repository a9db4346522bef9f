"""The split refresh: one version for one state of the table, and parts in order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airloom.plans import splits
from airloom.plans.forecast import Bundle, forecast_and_skipped, forecast_stored
from airloom.session import new_path
from airloom.sources import store

COLUMNS = ["us_aqi", "target"]


@pytest.fixture
def table(spark, series):
    """Hourly rows of two stations over 14 months, the last three without a target."""
    rows = series([float(i % 90) for i in range(24 * 420)]).unionByName(series([7.0] * 5, station=2, start=dt.datetime(2024, 3, 1)))
    path = new_path(spark, "t")
    store.rebuild(rows.withColumn("target", F.when(F.col("datetime") < "2025-02-23 21:00:00", F.col("us_aqi") + 1)), path, buckets=2)
    return path


def test_one_version_for_one_state(spark, series, table):
    snapshots = new_path(spark, "s")
    assert [splits.refresh_split(spark, table, snapshots, columns=COLUMNS) for _ in range(2)] == [1, 1]
    store.upsert(series([99.0]).withColumn("target", F.lit(98.0)), table)
    assert splits.refresh_split(spark, table, snapshots, columns=COLUMNS) == 2
    store.compact(spark, table)  # changes no row
    assert splits.refresh_split(spark, table, snapshots, columns=COLUMNS) == 2
    old, new = (store.read_snapshot(spark, snapshots, v).orderBy("datetime", "station").first() for v in (1, 2))
    assert (old.us_aqi, new.us_aqi, new.target) == (0.0, 99.0, 98.0)
    noted = {r.version: r for r in store.snapshot_metadata(spark, snapshots).collect()}
    assert noted[2].rows == 24 * 420 + 5 - 3 and noted[2].test_end == dt.datetime(2025, 2, 23, 20)
    assert noted[2].test_start == dt.datetime(2024, 2, 23, 21) and noted[2].train_end == dt.datetime(2024, 2, 23, 20)


def test_a_refresh_that_was_cut_off(spark, table):
    """Rows without bounds, as after a lost driver: the job makes the version anew."""
    snapshots = new_path(spark, "s")
    spark.range(3).withColumn("split", F.lit("train")).write.partitionBy("split").parquet(f"{snapshots}/td_version=1")
    assert [splits.refresh_split(spark, table, snapshots, columns=COLUMNS) for _ in range(2)] == [2, 2]
    assert store.latest_version(spark, snapshots) == 2


def test_a_table_without_ready_rows_makes_no_version(spark, series):
    path, snapshots = new_path(spark, "t"), new_path(spark, "s")
    store.rebuild(series([1.0]).withColumn("target", F.lit(None).cast("double")), path, buckets=1)
    with pytest.raises(ValueError, match="no training-ready rows"):
        splits.refresh_split(spark, path, snapshots, columns=COLUMNS)
    assert store.snapshot_metadata(spark, snapshots).count() == 0


def test_parts_have_their_columns_and_rows(spark, table):
    snapshots = new_path(spark, "s")
    splits.refresh_split(spark, table, snapshots, columns=COLUMNS)
    parts = splits.split_parts(spark, snapshots, ["us_aqi"], ["target"])
    assert [p.columns for p in parts] == [["station", "datetime", c] for c in ("us_aqi", "target")] * 2
    assert parts.features_train.count() == parts.labels_train.count() == 24 * 53 + 21
    assert parts.features_test.join(parts.labels_test, ["station", "datetime"]).filter("target = us_aqi + 1").count() == parts.labels_test.count()
    with pytest.raises(ValueError, match="lacks columns"):
        splits.split_parts(spark, snapshots, ["pm99"], ["target"])


def test_rows_out_of_order_raise(spark, series):
    rows = series([1.0] * 6).withColumn("split", F.when(F.hour("datetime") < 4, "train").otherwise("test"))
    assert splits.order_faults(rows) == {} and splits.order_faults(rows.limit(0)) == {}
    early = series([2.0]).withColumn("split", F.lit("test"))
    assert splits.order_faults(rows.unionByName(early)) == {"train_after_test": 4}
    assert splits.order_faults(rows.unionByName(rows.filter("split = 'train'"))) == {"repeated": 4}
    snapshots = new_path(spark, "s")
    store.write_snapshot(rows.unionByName(series([1.0], station=None).withColumn("split", F.lit("train"))), snapshots)
    with pytest.raises(ValueError, match="without_key"):
        splits.split_parts(spark, snapshots, ["us_aqi"], [])


def test_stored_forecasts_equal_those_of_the_whole_table(spark, table):
    bundles = [Bundle(h, "plain", ["us_aqi", *more], lambda rows: rows.withColumn("prediction", F.col("us_aqi") * 2))
               for h, more in ((24, []), (48, ["target"]))]
    for got, want in zip(forecast_stored(spark, table, bundles), forecast_and_skipped(store.read_table(spark, table), bundles), strict=True):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0
