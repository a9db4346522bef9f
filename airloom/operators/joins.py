"""Joins of observation tables on (station, datetime)."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import BEARINGS, KEY, POINT_COLUMNS
from ..session import join_in_place

POINT_VALUES = ("pm2_5", "us_aqi")


def join_sources(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Only hours that both sources have."""
    return weather.join(air, KEY, "inner")


def widen_points(points: DataFrame, bearings: dict = BEARINGS) -> DataFrame:
    """Long point series (station, datetime, bearing, values) to one column per value and bearing.
    One aggregation does what a chain of full outer joins would do in one shuffle each."""
    return points.groupBy(*KEY).agg(*[
        F.max(F.when(F.col("bearing") == b, F.col(v))).alias(f"{v}_dir_{b}")
        for v in POINT_VALUES for b in bearings
    ])


def outer_join_points(points: DataFrame, bearings: dict = BEARINGS) -> DataFrame:
    """The chain of full outer joins; same rows as :func:`widen_points` for unique keys."""
    series = [
        points.filter(F.col("bearing") == b).select(
            *KEY, *[F.col(v).alias(f"{v}_dir_{b}") for v in POINT_VALUES])
        for b in bearings
    ]
    return reduce(lambda a, b: a.join(b, KEY, "full_outer"), series).select(*KEY, *POINT_COLUMNS)


def attach_points(observations: DataFrame, wide_points: DataFrame) -> DataFrame:
    join_in_place(observations.sparkSession)
    return observations.join(wide_points, KEY, "left")


def recombine(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and labels by key."""
    return features.join(labels, KEY, "inner")
