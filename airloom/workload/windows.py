"""Window features over cleaned observations."""

from pyspark.sql import functions as F

from ..operators import windows as X
from ..operators.clean import clean, deduplicate
from ..operators.skew import with_position
from ..plans.training import cv_blocks, order_violations, pooled_cv_blocks
from ..operators.recent import last_rows
from ..schema import POLLUTANT_SHORT_NAMES
from . import views
from .catalog import comparable, comparable_sql, register
from .sql import change_sql, cleaned_obs_sql, cleaned_sql, lag_sql, rolling_sql
from .views import obs, obs_sql, station_tasks


def cleaned(spark, sf_dir, cols):
    """Cleaned observations with the hot-station profile, which later steps share."""
    tasks, hot = station_tasks(spark, sf_dir)
    return clean(obs(spark, sf_dir, cols, tasks=tasks), cols, hot=hot), hot


def _family(name, cols, first_pass=None, long_names=(), sql=()):
    """Register one feature family: keys plus its columns."""
    names = [s.rsplit(" AS ", 1)[1] for s in sql]
    body = f"SELECT station, datetime, {', '.join(sql)} FROM ({cleaned_obs_sql(cols)}) AS c"

    @register(name, comparable_sql(body, "station datetime", names))
    def query(spark, sf_dir):
        df, hot = cleaned(spark, sf_dir, cols)
        wide = X.rolling(df, first_pass or (lambda w: []), tuple(long_names), hot)
        return comparable(wide.select("station", "datetime", *names))


AQI = ["us_aqi"]
_family("w1_aqi_lags_at_horizons", AQI, lambda w: X.aqi_lags(w, [24, 48, 72]),
        sql=[lag_sql("us_aqi", h, f"aqi_lag_{h}h") for h in (24, 48, 72)])
_family("w2_aqi_lags_between_horizons", AQI, lambda w: X.aqi_lags(w, [6, 12, 36, 60]),
        sql=[lag_sql("us_aqi", h, f"aqi_lag_{h}h") for h in (6, 12, 36, 60)])
_family("w3_pollutant_lags", list(POLLUTANT_SHORT_NAMES.values()), X.pollutant_lags,
        sql=[lag_sql(c, h, f"{s}_lag_{h}h") for h in (24, 48, 72) for s, c in POLLUTANT_SHORT_NAMES.items()])
_family("w4_aqi_rolling_mean_24", AQI, long_names=["aqi_rolling_mean_24h"],
        sql=[rolling_sql("avg", "us_aqi", 24, "aqi_rolling_mean_24h")])
_family("w5_aqi_rolling_std_24", AQI, lambda w: X.aqi_day_frame(w)[:1],
        sql=[rolling_sql("stddev_samp", "us_aqi", 24, "aqi_rolling_std_24h")])
_family("w6_aqi_rolling_extremes_24", AQI, lambda w: X.aqi_day_frame(w)[1:],
        sql=[rolling_sql(a, "us_aqi", 24, f"aqi_rolling_{a}_24h") for a in ("max", "min")])
_family("w7_aqi_rolling_means_long", AQI, long_names=[f"aqi_rolling_mean_{n}h" for n in (48, 72, 168)],
        sql=[rolling_sql("avg", "us_aqi", n, f"aqi_rolling_mean_{n}h") for n in (48, 72, 168)])
_family("w8_pm_rolling_means_long", ["pm2_5", "pm10"],
        long_names=[f"{p}_rolling_mean_{n}h" for p in ("pm2_5", "pm10") for n in (48, 72, 168)],
        sql=[rolling_sql("avg", p, n, f"{p}_rolling_mean_{n}h") for p in ("pm2_5", "pm10") for n in (48, 72, 168)])
_family("w9_wind_rolling_24", ["wind_speed_10m"], X.wind_day_frame,
        sql=[rolling_sql("avg", "wind_speed_10m", 24, "wind_speed_rolling_mean_24h"),
             rolling_sql("stddev_samp", "wind_speed_10m", 24, "wind_speed_rolling_std_24h")])
_family("w10_precipitation_rolling_sums", ["precipitation"],
        long_names=[f"precipitation_rolling_sum_{n}h" for n in (24, 72)],
        sql=[rolling_sql("sum", "precipitation", n, f"precipitation_rolling_sum_{n}h") for n in (24, 72)])
_family("w11_one_step_changes", ["us_aqi", "pm2_5"], X.one_step_changes,
        sql=[change_sql("us_aqi", 1, "aqi_change_rate_1h"), change_sql("pm2_5", 1, "pm25_change_rate_1h")])
_family("w12_weather_changes", ["pressure_msl", "temperature_2m"], X.weather_changes,
        sql=[change_sql(c, 3, f"{c}_change_3h") for c in ("pressure_msl", "temperature_2m")])
_W = "OVER (PARTITION BY station ORDER BY datetime)"
_family("w13_aqi_acceleration", AQI, lambda w: [X.acceleration(w)],
        sql=[f"us_aqi - 2 * lag(us_aqi, 1) {_W} + lag(us_aqi, 2) {_W} AS aqi_acceleration_1h"])
_family("w14_forecast_targets", AQI, X.targets,
        sql=[f"lead(us_aqi, {h}) {_W} AS target_us_aqi_{h}h_ahead" for h in (24, 48, 72)])

REPAIR = ["us_aqi", "pm2_5", "pm10", "precipitation", "dew_point_2m"]


@register("w15_interpolation",
          comparable_sql(cleaned_obs_sql(REPAIR), "station datetime", REPAIR))
def interpolation(spark, sf_dir):
    return comparable(cleaned(spark, sf_dir, REPAIR)[0])


HOURLY = list(views.HOURLY_EVENTS)


@register("w15_interpolation_of_sparse_hours",
          comparable_sql(cleaned_sql(views.HOURLY_SQL, HOURLY), "station datetime", HOURLY))
def interpolation_hourly(spark, sf_dir):
    from ..streaming.hourly import hourly_means
    events = views.table(spark, sf_dir, "events").withColumn("station", F.expr("user_id % 4"))
    return comparable(clean(hourly_means(events, views.HOURLY_EVENTS), HOURLY))


# Each key twice: the stored row and a later copy with shifted values.
COPIES_SQL = (f"SELECT *, 0 AS ingest_seq FROM ({obs_sql(AQI)}) AS a "
              f"UNION ALL SELECT station, datetime, us_aqi + 1 AS us_aqi, 1 AS ingest_seq FROM ({obs_sql(AQI)}) AS b")


def copies(spark, sf_dir):
    """Both lie in the same tasks by station, so that no step over their keys puts more into a task as the table grows."""
    tasks, _ = station_tasks(spark, sf_dir)
    first = obs(spark, sf_dir, AQI, tasks=tasks).withColumn("ingest_seq", F.lit(0))
    later = obs(spark, sf_dir, AQI, tasks=tasks).select(
        "station", "datetime", (F.col("us_aqi") + 1).alias("us_aqi"), F.lit(1).alias("ingest_seq"))
    return first.unionByName(later)


@register("w16_deduplicate_keep_first", comparable_sql(
    "SELECT *, row_number() OVER (PARTITION BY station, datetime ORDER BY ingest_seq) AS rn "
    f"FROM ({COPIES_SQL}) AS u", "station datetime", "us_aqi") + " WHERE rn = 1")
def keep_first(spark, sf_dir):
    return comparable(deduplicate(copies(spark, sf_dir), "ingest_seq").drop("ingest_seq"))


@register("w17_cv_blocks",
          "SELECT station, datetime, CAST(greatest(0, ceil((rn - (n - 3 * (n // 4))) / "
          "CAST(greatest(n // 4, 1) AS DOUBLE))) AS BIGINT) AS cv_block FROM (SELECT station, datetime, "
          "row_number() OVER (PARTITION BY station ORDER BY datetime) AS rn, "
          f"count(*) OVER (PARTITION BY station) AS n FROM ({obs_sql(AQI)}) AS o) AS r")
def expanding_blocks(spark, sf_dir):
    return cv_blocks(obs(spark, sf_dir, AQI)).select(
        "station", "datetime", F.col("cv_block").cast("bigint").alias("cv_block"))


@register("w17_pooled_folds",
          f"WITH h AS (SELECT date_trunc('hour', datetime) AS hour, count(*) AS c FROM ({obs_sql(AQI)}) AS o GROUP BY 1), "
          "b AS (SELECT hour, coalesce(sum(c) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier, "
          "sum(c) OVER () AS n FROM h) SELECT station, datetime, CAST(greatest(0, ceil((earlier + 1 - (n - 3 * (n // 4))) / "
          f"CAST(greatest(n // 4, 1) AS DOUBLE))) AS BIGINT) AS cv_block FROM ({obs_sql(AQI)}) AS o JOIN b ON date_trunc('hour', datetime) = hour")
def pooled_blocks(spark, sf_dir):
    return pooled_cv_blocks(obs(spark, sf_dir, AQI)).select(
        "station", "datetime", F.col("cv_block").cast("bigint").alias("cv_block"))


@register("w18_last_rows", comparable_sql(
    "SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn "
    f"FROM ({obs_sql(AQI)}) AS o", "station datetime", "us_aqi") + " WHERE rn <= 48")
def tail_rows(spark, sf_dir):
    return comparable(last_rows(obs(spark, sf_dir, AQI), 48))


@register("w19_order_check",
          "SELECT station, CAST(coalesce(sum(CASE WHEN datetime < previous THEN 1 END), 0) AS BIGINT) AS out_of_order FROM ("
          "SELECT o_custkey AS station, o_orderdate AS datetime, "
          "lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous "
          "FROM orders) AS o GROUP BY 1")
def order_check(spark, sf_dir):
    arrivals = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station"), F.col("o_orderdate").alias("datetime"),
        F.col("o_orderkey").alias("seq"))
    return order_violations(arrivals, "seq")


@register("t1_time_order",
          "SELECT station, datetime, row_number() OVER (PARTITION BY station ORDER BY datetime) - 1 "
          f"AS position FROM ({obs_sql(AQI)}) AS o")
def time_order(spark, sf_dir):
    return with_position(obs(spark, sf_dir, AQI).select("station", "datetime")).select(
        "station", "datetime", F.col("_pos").alias("position"))
