import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from airloom.operators.skew import DEFAULT_MAX_ROWS, MAX_ROWS_SETTING  # noqa: E402
from airloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(params=["ordinary", "hot"])
def station_kind(request, spark):
    """Run a test twice: with whole stations per task, and cut into small blocks."""
    spark.conf.set(MAX_ROWS_SETTING, str(DEFAULT_MAX_ROWS if request.param == "ordinary" else 40))
    yield request.param
    spark.conf.set(MAX_ROWS_SETTING, str(DEFAULT_MAX_ROWS))


@pytest.fixture
def series(spark):
    """Build (station, datetime, column) rows from a list of values."""
    def build(values, column="us_aqi", station=1, start=START):
        rows = [(station, start + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, f"station long, datetime timestamp_ntz, {column} double")
    return build
