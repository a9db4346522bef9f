"""Registered queries against their SQL on the smallest tables (the driver uses larger ones)."""

import pytest
from conftest import SF
from oracle import compare, connect

import __spark_entry__ as entry
from airloom import workload
from airloom.operators.skew import DEFAULT_MAX_ROWS, MAX_ROWS_SETTING

SLOW = {"i1_stream_refresh"}
BLOCKED = [  # again with every station cut into blocks
    "w3_pollutant_lags", "w8_pm_rolling_means_long", "w14_forecast_targets", "w15_interpolation", "w17_cv_blocks",
    "j8_u3_missing_steps", "t1_time_order", "p3_training_ready",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(workload.oracle_sql()) - SLOW))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, con.execute(entry.oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", BLOCKED)
def test_query_with_hot_stations(spark, con, name):
    spark.conf.set(MAX_ROWS_SETTING, "300")
    try:
        got = entry.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set(MAX_ROWS_SETTING, str(DEFAULT_MAX_ROWS))
    assert compare(got, con.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 30


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
