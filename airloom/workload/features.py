"""Row features and the whole feature plan."""

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..plans import features as P
from ..plans.training import training_ready, warmed_up
from ..schema import (
    BEARINGS, EDGE_SENSITIVE, LOW_VALUE_FEATURES, POINT_COLUMNS, POLLUTANT_SHORT_NAMES,
)
from ..sources.holidays import flag_holidays, holidays_of
from .catalog import comparable, comparable_sql, register
from .sql import change_sql, cleaned_sql, lag_sql, lead_sql, rolling_sql
from .sources import WIDE_POINTS_SQL
from .views import ALL_VARS, HOURLY_SQL, obs, obs_sql, points, station_tasks, table
from .explore import hourly_obs

KEYS_SQL = obs_sql(["us_aqi"])


def holidays(spark, sf_dir):
    """The whole calendar of the years in the data."""
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("datetime"))
    return holidays_of(days)


# Civil holidays, and lunar ones as (month, first day, number of days).
HOLIDAY_DAYS = ["02-05", "03-23", "05-01", "08-14", "11-09", "12-25"]
LUNAR_DAYS = [(10, 1, 3), (12, 10, 3), (3, 12, 1), (1, 9, 2)]
# end of fixed values
LUNAR_SQL = (  # the arithmetic lunar calendar, from 1921 to 2134
    "SELECT DATE '0622-07-18' + CAST((y - 1) * 354 + (3 + 11 * y) // 30 + 29 * (m - 1) + m // 2 + d + extra AS INTEGER) "
    f"FROM range(1340, 1560) AS ys(y), (VALUES {', '.join(map(str, LUNAR_DAYS))}) AS l(m, d, n), range(0, 3) AS es(extra) WHERE extra < n")
IS_HOLIDAY = (
    f"CASE WHEN strftime(datetime, '%m-%d') IN ({', '.join(repr(d) for d in HOLIDAY_DAYS)}) "
    "AND NOT (strftime(datetime, '%m-%d') = '11-09' AND year(datetime) BETWEEN 2015 AND 2021) "
    f"OR CAST(datetime AS DATE) IN ({LUNAR_SQL}) THEN 1 ELSE 0 END")
IS_WEEKEND = "CASE WHEN isodow(datetime) IN (6, 7) THEN 1 ELSE 0 END"
IS_RUSH = "CASE WHEN hour(datetime) BETWEEN 7 AND 9 OR hour(datetime) BETWEEN 17 AND 20 THEN 1 ELSE 0 END"


@register("f1_calendar_parts",
          "SELECT station, datetime, hour(datetime) AS hour, day(datetime) AS day, month(datetime) AS month, "
          f"dayofyear(datetime) AS day_of_year FROM ({HOURLY_SQL}) AS o")
def calendar_parts(spark, sf_dir):
    rows = hourly_obs(spark, sf_dir).select("station", "datetime")
    return comparable(rows.withColumns(S.calendar_parts(F.col("datetime"))))


@register("f2_f3_weekend_and_rush_hour",
          f"SELECT station, datetime, CAST({IS_WEEKEND} AS BIGINT) AS is_weekend, CAST({IS_RUSH} AS BIGINT) AS is_rush_hour "
          f"FROM ({HOURLY_SQL}) AS o")
def weekend_rush(spark, sf_dir):
    dt = F.col("datetime")
    return comparable(hourly_obs(spark, sf_dir).select(
        "station", "datetime", S.is_weekend(dt).alias("is_weekend"), S.is_rush_hour(dt).alias("is_rush_hour")))


@register("f4_j4_public_holidays",
          f"SELECT station, datetime, CAST({IS_HOLIDAY} AS BIGINT) AS is_public_holiday FROM ({KEYS_SQL}) AS o")
def public_holidays(spark, sf_dir):
    return comparable(flag_holidays(obs(spark, sf_dir, ["us_aqi"]), holidays(spark, sf_dir)).drop("us_aqi"))


def _cycle_sql(c: str, period: int, name: str) -> str:
    return f"sin({c} * 2 * pi() / {period}) AS {name}_sin, cos({c} * 2 * pi() / {period}) AS {name}_cos"


_CYCLES = ("hour_sin hour_cos month_sin month_cos day_of_year_sin day_of_year_cos "
           "wind_direction_10m_sin wind_direction_10m_cos")


@register("f5_cyclical_encoding", comparable_sql(
    f"SELECT station, datetime, {_cycle_sql('hour(datetime)', 24, 'hour')}, {_cycle_sql('month(datetime)', 12, 'month')}, "
    f"{_cycle_sql('dayofyear(datetime)', 366, 'day_of_year')}, {_cycle_sql('wind_direction_10m', 360, 'wind_direction_10m')} "
    f"FROM ({obs_sql(['wind_direction_10m'])}) AS o", "station datetime", _CYCLES))
def cycles(spark, sf_dir):
    rows = obs(spark, sf_dir, ["wind_direction_10m"])
    parts = S.calendar_parts(F.col("datetime"))
    del parts["day"]
    return comparable(P.encode_cycles(rows.withColumns(parts)))


@register("f6_pm_ratio", comparable_sql(
    f"SELECT station, datetime, pm2_5 / (pm10 + 0.001) AS pm25_pm10_ratio FROM ({obs_sql(['pm2_5', 'pm10'])}) AS o",
    "station datetime", "pm25_pm10_ratio"))
def ratio(spark, sf_dir):
    return comparable(obs(spark, sf_dir, ["pm2_5", "pm10"]).select(
        "station", "datetime", S.pm_ratio().alias("pm25_pm10_ratio")))


@register("f8_stagnation_index", comparable_sql(
    "SELECT station, datetime, (1 / (wind + 1)) * (1 / (rain + 1)) AS stagnation_index FROM (SELECT station, datetime, "
    f"{rolling_sql('avg', 'wind_speed_10m', 24, 'wind')}, {rolling_sql('sum', 'precipitation', 24, 'rain')} "
    f"FROM ({cleaned_sql(obs_sql(['wind_speed_10m', 'precipitation']), ['wind_speed_10m', 'precipitation'])}) AS c) AS f",
    "station datetime", "stagnation_index"))
def stagnation(spark, sf_dir):
    from ..operators import windows as X
    from .windows import cleaned
    df, hot = cleaned(spark, sf_dir, ["wind_speed_10m", "precipitation"])
    wide = X.rolling(df, X.wind_day_frame, ("precipitation_rolling_sum_24h",), hot)
    index = S.stagnation(F.col("wind_speed_rolling_mean_24h"), F.col("precipitation_rolling_sum_24h"))
    return comparable(wide.select("station", "datetime", index.alias("stagnation_index")))


def _weight_sql(b: str) -> str:
    return f"greatest(cos(radians(wind_direction_10m) - radians({BEARINGS[b]}.0)), 0)"


def upwind_sql(value: str, name: str) -> str:
    total = "(" + " + ".join(_weight_sql(b) for b in BEARINGS) + " + 0.000001)"
    return " + ".join(f"{_weight_sql(b)} / {total} * {value}_dir_{b}" for b in BEARINGS) + f" AS {name}"


def with_points_sql(body: str) -> str:
    return (f"SELECT o.*, {', '.join('p.' + c for c in POINT_COLUMNS)} FROM ({body}) AS o LEFT JOIN ({WIDE_POINTS_SQL}) AS p "
            "ON o.station = p.station AND o.datetime = p.datetime")


@register("f9_upwind_blend", comparable_sql(
    f"SELECT station, datetime, {upwind_sql('us_aqi', 'aqi_upwind')}, {upwind_sql('pm2_5', 'pm25_upwind')} FROM "
    f"({with_points_sql(obs_sql(['wind_direction_10m']))}) AS j", "station datetime", "aqi_upwind pm25_upwind"))
def upwind(spark, sf_dir):
    rows = J.attach_points(obs(spark, sf_dir, ["wind_direction_10m"]), J.widen_points(points(spark, sf_dir)))
    wind = F.col("wind_direction_10m")
    return comparable(rows.select("station", "datetime", S.upwind_blend("us_aqi", wind).alias("aqi_upwind"),
                                  S.upwind_blend("pm2_5", wind).alias("pm25_upwind")))


@register("f13_target_time",
          "SELECT station, datetime, h AS horizon_hours, datetime + to_hours(CAST(h AS INTEGER)) AS target_datetime "
          f"FROM ({HOURLY_SQL}) AS o CROSS JOIN (VALUES (24), (48), (72)) AS v(h)")
def target_times(spark, sf_dir):
    hours = F.explode(F.array(F.lit(24), F.lit(48), F.lit(72))).alias("horizon_hours")
    rows = hourly_obs(spark, sf_dir).select("station", "datetime", hours)
    return comparable(rows.withColumn("target_datetime", S.target_time(F.col("datetime"), F.col("horizon_hours"))))


# --- the whole plan -----------------------------------------------------------------------------

def observations(spark, sf_dir, tasks=None):
    """All 22 variables and the eight spatial columns."""
    return J.attach_points(obs(spark, sf_dir, tasks=tasks), J.widen_points(points(spark, sf_dir, tasks)))


def features(spark, sf_dir):
    # stations of the left join are those of the weather side: count there, not over the join
    tasks, hot = station_tasks(spark, sf_dir)
    return P.feature_plan(observations(spark, sf_dir, tasks), holidays(spark, sf_dir), hot=hot)


_RAW_COLUMNS = ALL_VARS + POINT_COLUMNS
_FEATURE_SQL = [
    *[lag_sql("us_aqi", h, f"aqi_lag_{h}h") for h in (6, 12, 24, 36, 48, 60, 72)],
    *[lag_sql(c, h, f"{s}_lag_{h}h") for h in (24, 48, 72) for s, c in POLLUTANT_SHORT_NAMES.items()],
    *[rolling_sql("avg", "us_aqi", n, f"aqi_rolling_mean_{n}h") for n in (24, 48, 72, 168)],
    *[rolling_sql("avg", p, n, f"{p}_rolling_mean_{n}h") for p in ("pm2_5", "pm10") for n in (48, 72, 168)],
    rolling_sql("stddev_samp", "us_aqi", 24, "aqi_rolling_std_24h"),
    rolling_sql("max", "us_aqi", 24, "aqi_rolling_max_24h"),
    rolling_sql("min", "us_aqi", 24, "aqi_rolling_min_24h"),
    rolling_sql("avg", "wind_speed_10m", 24, "wind_speed_rolling_mean_24h"),
    rolling_sql("stddev_samp", "wind_speed_10m", 24, "wind_speed_rolling_std_24h"),
    rolling_sql("sum", "precipitation", 24, "precipitation_rolling_sum_24h"),
    rolling_sql("sum", "precipitation", 72, "precipitation_rolling_sum_72h"),
    change_sql("us_aqi", 1, "aqi_change_rate_1h"),
    "us_aqi - 2 * lag(us_aqi, 1) OVER (PARTITION BY station ORDER BY datetime) + lag(us_aqi, 2) "
    "OVER (PARTITION BY station ORDER BY datetime) AS aqi_acceleration_1h",
    change_sql("temperature_2m", 3, "temperature_2m_change_3h"),
    *[lead_sql("us_aqi", h, f"target_us_aqi_{h}h_ahead") for h in (24, 48, 72)],
]
_WINDOWED_SQL = (f"SELECT *, {', '.join(_FEATURE_SQL)} FROM "
                 f"({cleaned_sql(with_points_sql(obs_sql()), _RAW_COLUMNS)}) AS c")
FEATURES_SQL = (
    f"SELECT *, CAST(day(datetime) AS BIGINT) AS day, CAST({IS_WEEKEND} AS BIGINT) AS is_weekend, "
    f"CAST({IS_HOLIDAY} AS BIGINT) AS is_public_holiday, pm2_5 / (pm10 + 0.001) AS pm25_pm10_ratio, "
    "(1 / (wind_speed_rolling_mean_24h + 1)) * (1 / (precipitation_rolling_sum_24h + 1)) AS stagnation_index, "
    f"{upwind_sql('us_aqi', 'aqi_upwind')}, {upwind_sql('pm2_5', 'pm25_upwind')}, "
    f"{_cycle_sql('hour(datetime)', 24, 'hour')}, {_cycle_sql('month(datetime)', 12, 'month')}, "
    f"{_cycle_sql('dayofyear(datetime)', 366, 'day_of_year')}, {_cycle_sql('wind_direction_10m', 360, 'wind_direction_10m')} "
    f"FROM ({_WINDOWED_SQL}) AS w")
INTEGERS = ["day", "is_weekend", "is_public_holiday"]
_ALL_NAMES = [
    *_RAW_COLUMNS, *[f.rsplit(" AS ", 1)[1] for f in _FEATURE_SQL], "pm25_pm10_ratio", "stagnation_index",
    "aqi_upwind", "pm25_upwind", "hour_sin", "hour_cos", "month_sin", "month_cos", "day_of_year_sin",
    "day_of_year_cos", "wind_direction_10m_sin", "wind_direction_10m_cos",
]
FEATURE_DOUBLES = [c for c in _ALL_NAMES if c not in LOW_VALUE_FEATURES and c != "wind_direction_10m"]


@register("e1_p2_feature_plan", comparable_sql(FEATURES_SQL, ["station", "datetime", *INTEGERS], FEATURE_DOUBLES))
def feature_table(spark, sf_dir):
    return comparable(features(spark, sf_dir))


@register("p3_training_ready", comparable_sql(FEATURES_SQL, "station datetime", EDGE_SENSITIVE)
          + " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in EDGE_SENSITIVE))
def ready(spark, sf_dir):
    return comparable(training_ready(features(spark, sf_dir)).select("station", "datetime", *EDGE_SENSITIVE))


@register("p4_warm_up_filter", comparable_sql(FEATURES_SQL, "station datetime", "us_aqi aqi_rolling_mean_168h")
          + " WHERE aqi_rolling_mean_168h IS NOT NULL")
def warm(spark, sf_dir):
    return comparable(warmed_up(features(spark, sf_dir)).select("station", "datetime", "us_aqi", "aqi_rolling_mean_168h"))


@register("p9_background_sample", comparable_sql(
    "SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS kept FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn FROM ({obs_sql(['us_aqi', 'pm2_5', 'pm10'])}) AS o) AS r "
    "WHERE rn <= 600 AND pm2_5 IS NOT NULL AND pm10 IS NOT NULL", "station datetime", "us_aqi pm2_5 pm10")
    + " WHERE kept <= 300")
def background_rows(spark, sf_dir):
    from ..models.explain import background
    cols = ["us_aqi", "pm2_5", "pm10"]
    return comparable(background(obs(spark, sf_dir, cols), cols).drop("background_row"))

