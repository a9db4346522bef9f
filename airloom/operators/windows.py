"""Lags, rolling frames, changes and targets. Everything counts rows, not hours.

A rolling value is null unless its frame is full and has no null. The builders return named
columns over a given window, so a whole family goes into one ``select`` and all families share one
exchange and one sort. Frames longer than a day are assembled from day sums of earlier rows
(``lag`` is constant work per row; a 168-row frame would re-read 168 rows for every row).
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schema import (
    AQI_LAG_HOURS, DAY_WINDOW, HORIZONS, LONG_WINDOW, POLLUTANT_LAG_HOURS, POLLUTANT_SHORT_NAMES,
    TARGET,
)
from .skew import HotStations, over_station


def by_time(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("datetime")


def lag(c: str, rows: int, w: WindowSpec) -> Column:
    return F.lag(c, rows).over(w)


def full_frame(agg: Callable, c: str, rows: int, w: WindowSpec) -> Column:
    frame = w.rowsBetween(-(rows - 1), 0)
    full = F.count(c).over(frame) == rows
    return F.when(full, agg(c).over(frame))


def day_sum_name(c: str) -> str:
    return f"_day_sum_{c}"


def day_sum(c: str, w: WindowSpec) -> Column:
    return full_frame(F.sum, c, DAY_WINDOW, w).alias(day_sum_name(c))


def long_sum(c: str, rows: int, w: WindowSpec) -> Column:
    """Sum over ``rows`` (whole days) from the day sums ending 0, 24, 48 ... rows back."""
    days, rest = divmod(rows, DAY_WINDOW)
    if rest:
        raise ValueError("long frames are whole multiples of the day frame")
    total = F.col(day_sum_name(c))
    for day in range(1, days):
        total = total + F.lag(day_sum_name(c), day * DAY_WINDOW).over(w)
    return total


def long_mean(c: str, rows: int, w: WindowSpec) -> Column:
    return long_sum(c, rows, w) / rows


# --- feature families: first pass over the cleaned rows ------------------------------------

def aqi_lags(w: WindowSpec, hours: list[int] = AQI_LAG_HOURS) -> list[Column]:
    return [lag(TARGET, h, w).alias(f"aqi_lag_{h}h") for h in hours]


def pollutant_lags(w: WindowSpec) -> list[Column]:
    return [
        lag(c, h, w).alias(f"{short}_lag_{h}h")
        for h in POLLUTANT_LAG_HOURS for short, c in POLLUTANT_SHORT_NAMES.items()
    ]


def aqi_day_frame(w: WindowSpec) -> list[Column]:
    return [
        full_frame(F.stddev_samp, TARGET, DAY_WINDOW, w).alias("aqi_rolling_std_24h"),
        full_frame(F.max, TARGET, DAY_WINDOW, w).alias("aqi_rolling_max_24h"),
        full_frame(F.min, TARGET, DAY_WINDOW, w).alias("aqi_rolling_min_24h"),
    ]


def wind_day_frame(w: WindowSpec) -> list[Column]:
    return [
        full_frame(F.avg, "wind_speed_10m", DAY_WINDOW, w).alias("wind_speed_rolling_mean_24h"),
        full_frame(F.stddev_samp, "wind_speed_10m", DAY_WINDOW, w).alias("wind_speed_rolling_std_24h"),
    ]


def change(c: str, rows: int, w: WindowSpec) -> Column:
    return F.col(c) - lag(c, rows, w)


def one_step_changes(w: WindowSpec) -> list[Column]:
    return [
        change(TARGET, 1, w).alias("aqi_change_rate_1h"),
        change("pm2_5", 1, w).alias("pm25_change_rate_1h"),
    ]


def weather_changes(w: WindowSpec) -> list[Column]:
    return [change(c, 3, w).alias(f"{c}_change_3h") for c in ("pressure_msl", "temperature_2m")]


def acceleration(w: WindowSpec) -> Column:
    recent = F.col(TARGET) - lag(TARGET, 1, w)
    earlier = lag(TARGET, 1, w) - lag(TARGET, 2, w)
    return (recent - earlier).alias("aqi_acceleration_1h")


def targets(w: WindowSpec, horizons=HORIZONS) -> list[Column]:
    return [F.lead(TARGET, h).over(w).alias(f"target_{TARGET}_{h}h_ahead") for h in horizons]


# --- second pass over the day sums -----------------------------------------------------------

LONG_MEANS = {
    "aqi_rolling_mean_24h": (TARGET, 24),
    "aqi_rolling_mean_48h": (TARGET, 48),
    "aqi_rolling_mean_72h": (TARGET, 72),
    "aqi_rolling_mean_168h": (TARGET, LONG_WINDOW),
    "pm2_5_rolling_mean_48h": ("pm2_5", 48),
    "pm2_5_rolling_mean_72h": ("pm2_5", 72),
    "pm2_5_rolling_mean_168h": ("pm2_5", LONG_WINDOW),
    "pm10_rolling_mean_48h": ("pm10", 48),
    "pm10_rolling_mean_72h": ("pm10", 72),
    "pm10_rolling_mean_168h": ("pm10", LONG_WINDOW),
}
LONG_SUMS = {
    "precipitation_rolling_sum_24h": ("precipitation", 24),
    "precipitation_rolling_sum_72h": ("precipitation", 72),
}


def long_frames(w: WindowSpec, names: list[str]) -> list[Column]:
    means = [long_mean(*LONG_MEANS[n], w).alias(n) for n in names if n in LONG_MEANS]
    return means + [long_sum(*LONG_SUMS[n], w).alias(n) for n in names if n in LONG_SUMS]


def add_frames(
    df: DataFrame, first_pass: Callable[[WindowSpec], list[Column]], long_names: list[str],
    keys: list[str],
) -> DataFrame:
    """Both passes over one window spec: no second exchange, no second sort."""
    w = by_time(keys)
    known = {**LONG_MEANS, **LONG_SUMS}
    summed = list(dict.fromkeys(known[n][0] for n in long_names))
    once = df.select("*", *first_pass(w), *[day_sum(c, w) for c in summed])
    return once.select("*", *long_frames(w, long_names)).drop(*[day_sum_name(c) for c in summed])


def rolling(
    df: DataFrame, first_pass: Callable[[WindowSpec], list[Column]] = lambda w: [],
    long_names: tuple[str, ...] = (), hot: HotStations | None = None,
) -> DataFrame:
    """Add any of the families above to a cleaned table, for stations of any length."""
    return over_station(
        df, lambda part, keys: add_frames(part, first_pass, list(long_names), keys),
        before=LONG_WINDOW, after=max(HORIZONS), hot=hot,
    )
