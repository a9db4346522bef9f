"""The feature plan: one function for backfill and for the incremental refresh."""

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import windows as X
from ..operators.clean import clean
from ..operators.skew import HotStations, find_hot_stations
from ..schema import (
    AIR_QUALITY_VARS, CYCLE_PERIODS, KEY, LOW_VALUE_FEATURES, POINT_COLUMNS, TARGET, WEATHER_VARS,
)
from ..sources.holidays import flag_holidays


def _first_pass(w: WindowSpec) -> list[Column]:
    return [
        *X.aqi_lags(w), *X.one_step_changes(w), X.acceleration(w), *X.aqi_day_frame(w),
        *X.pollutant_lags(w), *X.wind_day_frame(w), *X.weather_changes(w), *X.targets(w),
    ]


def add_window_features(df: DataFrame, hot: HotStations | None = None) -> DataFrame:
    return X.rolling(df, _first_pass, (*X.LONG_MEANS, *X.LONG_SUMS), hot)


def add_row_features(df: DataFrame, holidays: DataFrame) -> DataFrame:
    dt = F.col("datetime")
    out = flag_holidays(df, holidays).withColumns({
        **S.calendar_parts(dt),
        "is_weekend": S.is_weekend(dt),
        "is_rush_hour": S.is_rush_hour(dt),
        "pm25_pm10_ratio": S.pm_ratio(),
        "stagnation_index": S.stagnation(
            F.col("wind_speed_rolling_mean_24h"), F.col("precipitation_rolling_sum_24h")),
    })
    if all(c in df.columns for c in POINT_COLUMNS):
        wind = F.col("wind_direction_10m")
        out = out.withColumns({
            "aqi_upwind": S.upwind_blend("us_aqi", wind),
            "pm25_upwind": S.upwind_blend("pm2_5", wind),
        })
    return out


def encode_cycles(df: DataFrame) -> DataFrame:
    """Replace periodic columns by sine and cosine; future wind columns too, where present."""
    periods = {c: p for c, p in CYCLE_PERIODS.items() if c in df.columns}
    periods |= {c: 360 for c in df.columns
                if c == "wind_direction_10m" or c.startswith("wind_direction_10m_future_")}
    encoded = {}
    for c, period in periods.items():
        encoded[f"{c}_sin"], encoded[f"{c}_cos"] = S.cycle(F.col(c), period)
    return df.withColumns(encoded).drop(*periods)


def drop_low_value(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in LOW_VALUE_FEATURES if c in df.columns])


def feature_plan(
    raw: DataFrame, holidays: DataFrame, seq: str | None = None, hot: HotStations | None = None,
) -> DataFrame:
    """Raw observations to the feature table: clean, window features, targets, row features,
    cyclical encoding, drop of low-value columns."""
    hot = hot or find_hot_stations(raw)
    present = [c for c in WEATHER_VARS + AIR_QUALITY_VARS + POINT_COLUMNS if c in raw.columns]
    rows = raw.select(*KEY, *present, *([seq] if seq else []))

    def windowed(part: DataFrame, kind: HotStations) -> DataFrame:
        cleaned = clean(part, present, seq, hot=kind).select(*KEY, *present)
        return add_window_features(cleaned, kind)

    # cleaning and features stay together per kind, so ordinary stations are shuffled once for both
    both = hot.apply(
        rows, lambda d: windowed(d, HotStations()), lambda d: windowed(d, HotStations(every=True)))
    return drop_low_value(encode_cycles(add_row_features(both, holidays)))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEY and not c.startswith("target_")]


def horizon_features(columns: list[str], horizon: int) -> list[str]:
    """Leave out weather that belongs to another forecast horizon."""
    others = [f"_future_{h}h" for h in (24, 48, 72) if h != horizon]
    return [c for c in columns if not any(o in c for o in others)]


def training_target(horizon: int) -> str:
    return f"target_{TARGET}_{horizon}h_ahead"
