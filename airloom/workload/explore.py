"""Exploratory aggregates, categories and alerts."""

from pyspark.sql import functions as F

from ..functions import aqi as Q
from ..functions.scalars import round_half_even
from ..operators import explore as E
from ..schema import DISTRIBUTION_POLLUTANTS
from .catalog import comparable, comparable_sql, register
from .views import HOURLY_EVENTS, HOURLY_SQL, obs, obs_sql, table

AQI_SQL = obs_sql(["us_aqi"])
POLLUTANT_SQL = obs_sql(["pm2_5"])
CASES = [(low, high, name, color, text) for low, high, name, color, text in Q.BREAKPOINTS]


def hourly_obs(spark, sf_dir):
    from ..streaming.hourly import hourly_means
    events = table(spark, sf_dir, "events").withColumn("station", F.expr("user_id % 4"))
    return hourly_means(events, HOURLY_EVENTS)


def sparse_obs(spark, sf_dir):
    """Observations whose AQI is missing on days without returned goods."""
    return obs(spark, sf_dir, ["pm2_5"]).withColumnRenamed("pm2_5", "us_aqi").withColumn(
        "us_aqi", F.col("us_aqi") * 6)


SPARSE_SQL = f"SELECT station, datetime, pm2_5 * 6 AS us_aqi FROM ({POLLUTANT_SQL}) AS o"


@register("a1_a2_summary_per_station", comparable_sql(
    "SELECT station, count(*) AS rows, min(datetime) AS first_datetime, max(datetime) AS last_datetime, "
    "max_by(us_aqi, CASE WHEN us_aqi IS NOT NULL THEN datetime END) AS current_aqi, "
    "round_even(avg(us_aqi), 1) AS mean_aqi, round_even(max(us_aqi), 1) AS max_aqi, round_even(min(us_aqi), 1) AS min_aqi, "
    "round_even(avg(CASE WHEN us_aqi > 150 THEN 1 ELSE 0 END) * 100, 1) AS pct_unhealthy_or_worse "
    f"FROM ({SPARSE_SQL}) AS o GROUP BY 1",
    "station rows first_datetime last_datetime",
    "current_aqi mean_aqi max_aqi min_aqi pct_unhealthy_or_worse"))
def summary(spark, sf_dir):
    return comparable(E.summary(sparse_obs(spark, sf_dir)))


@register("a2_percent_unhealthy", comparable_sql(
    f"SELECT avg(CASE WHEN us_aqi > 150 THEN 1 ELSE 0 END) * 100 AS pct FROM ({SPARSE_SQL}) AS o", "", "pct"))
def percent_unhealthy(spark, sf_dir):
    return comparable(sparse_obs(spark, sf_dir).agg(E.unhealthy_share().alias("pct")))


@register("a3_j9_daily_mean_with_empty_days", comparable_sql(
    "SELECT s.station, s.date, d.mean_aqi FROM (SELECT station, unnest(generate_series(first, last, INTERVAL 1 DAY)) AS date "
    f"FROM (SELECT station, min(datetime) AS first, max(datetime) AS last FROM ({SPARSE_SQL}) AS o GROUP BY 1) AS r) AS s "
    "LEFT JOIN (SELECT station, date_trunc('day', datetime) AS date, avg(us_aqi) AS mean_aqi "
    f"FROM ({SPARSE_SQL}) AS o GROUP BY 1, 2) AS d ON s.station = d.station AND s.date = d.date",
    "station date", "mean_aqi"))
def daily(spark, sf_dir):
    return comparable(E.daily_mean(sparse_obs(spark, sf_dir)))


@register("a4_mean_by_hour_of_day", comparable_sql(
    f"SELECT hour(datetime) AS hour, avg(us_aqi) AS mean_aqi FROM ({HOURLY_SQL}) AS o GROUP BY 1", "hour", "mean_aqi"))
def by_hour(spark, sf_dir):
    return comparable(E.mean_by_hour(hourly_obs(spark, sf_dir)))


@register("a5_by_month", comparable_sql(
    "SELECT month(datetime) AS month, avg(us_aqi) AS mean_aqi, min(us_aqi) AS min_aqi, max(us_aqi) AS max_aqi "
    f"FROM ({AQI_SQL}) AS o GROUP BY 1", "month", "mean_aqi min_aqi max_aqi"))
def by_month(spark, sf_dir):
    return comparable(E.by_month(obs(spark, sf_dir, ["us_aqi"])))


def _box_sql(body: str, groups: str) -> str:
    first = (f"SELECT {groups}, count(v) AS n, min(v) AS min, max(v) AS max, quantile_cont(v, 0.25) AS q1, "
             f"quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM ({body}) AS b WHERE v IS NOT NULL GROUP BY {groups}")
    using = ", ".join(g.strip() for g in groups.split(","))
    return (f"SELECT {groups}, n, any_value(q.min) AS min, any_value(q.max) AS max, any_value(q1) AS q1, any_value(median) AS median, "
            f"any_value(q3) AS q3, min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS lower_whisker, "
            f"max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS upper_whisker "
            f"FROM ({body}) AS b JOIN ({first}) AS q USING ({using}) GROUP BY {groups}, n")


BOX = "min max q1 median q3 lower_whisker upper_whisker"


@register("a6_f18_monthly_distribution", comparable_sql(
    _box_sql(f"SELECT month(datetime) AS month, monthname(datetime) AS month_name, us_aqi AS v FROM ({AQI_SQL}) AS o",
             "month, month_name"), "month month_name n", BOX))
def monthly(spark, sf_dir):
    return comparable(E.monthly_distribution(obs(spark, sf_dir, ["us_aqi"])))


@register("a7_pollutant_distribution", comparable_sql(
    _box_sql(" UNION ALL ".join(
        f"SELECT '{c}' AS pollutant, {c} AS v FROM ({obs_sql(DISTRIBUTION_POLLUTANTS)}) AS o{i}"
        for i, c in enumerate(DISTRIBUTION_POLLUTANTS)), "pollutant"), "pollutant n", BOX))
def pollutants(spark, sf_dir):
    return comparable(E.pollutant_distribution(obs(spark, sf_dir, DISTRIBUTION_POLLUTANTS)))


CORRELATED = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "pressure_msl", "cloud_cover", "wind_speed_10m",
    "wind_direction_10m", "dew_point_2m", "apparent_temperature", "wind_gusts_10m", "cloud_cover_high",
    "surface_pressure", "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "us_aqi",
]
_CORR_SQL = (
    "SELECT \"column\", abs_corr, row_number() OVER (ORDER BY abs_corr DESC NULLS LAST, \"column\") AS rank FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", abs(corr({c}, us_aqi)) AS abs_corr FROM o" for c in CORRELATED) + ") AS c")
_CORR_WITH = f"WITH o AS ({obs_sql(CORRELATED)}) "


@register("a8_correlation_ranking", comparable_sql(_CORR_WITH + _CORR_SQL, '"column" rank', "abs_corr"))
def ranking(spark, sf_dir):
    return comparable(E.correlations(obs(spark, sf_dir, CORRELATED), cols=CORRELATED))


@register("t5_top_correlated", comparable_sql(
    f"{_CORR_WITH} SELECT * FROM ({_CORR_SQL}) AS r WHERE rank <= 15", '"column" rank', "abs_corr"))
def top_columns(spark, sf_dir):
    return comparable(E.top_correlated(obs(spark, sf_dir, CORRELATED), cols=CORRELATED))


_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS corr FROM o" for a in CORRELATED for b in CORRELATED)


@register("a9_correlation_matrix", comparable_sql(
    f"{_CORR_WITH}, top AS (SELECT \"column\" AS name FROM ({_CORR_SQL}) AS r WHERE rank <= 15) "
    f"SELECT * FROM ({_PAIRS_SQL}) AS p WHERE column_a IN (SELECT name FROM top) AND column_b IN (SELECT name FROM top)",
    "column_a column_b", "corr"))
def matrix(spark, sf_dir):
    return comparable(E.correlation_matrix(obs(spark, sf_dir, CORRELATED), cols=CORRELATED))


# --- categories and alerts --------------------------------------------------------------------

def case_sql(value: str, part: int, mode: str = "reference") -> str:
    unknown = Q.UNKNOWN[part - 2]
    out = f"CASE WHEN {value} IS NULL THEN '{unknown}' "
    for row in CASES:
        inside = f"{value} BETWEEN {row[0]} AND {row[1]}" if mode == "reference" else f"{value} <= {row[1]}"
        out += f"WHEN {inside} THEN '{row[part]}' "
    return out + f"ELSE '{CASES[-1][part]}' END"


_ONE_DIGIT_SQL = f"SELECT station, datetime, round_even(us_aqi, 1) AS aqi FROM ({SPARSE_SQL}) AS o"


def _classified(mode):
    return comparable_sql(
        f"SELECT station, datetime, {case_sql('aqi', 2, mode)} AS category, {case_sql('aqi', 3, mode)} AS color, "
        f"{case_sql('aqi', 4, mode)} AS message, aqi AS value FROM ({_ONE_DIGIT_SQL}) AS v",
        "station datetime category color message", "value")


def _classify(spark, sf_dir, mode):
    rows = sparse_obs(spark, sf_dir).withColumn("aqi", round_half_even(F.col("us_aqi"), 1))
    return comparable(rows.withColumn("_c", Q.classify(F.col("aqi"), mode)).select("station", "datetime", "_c.*"))


@register("f11_j6_classify", _classified("reference"))
def classified(spark, sf_dir):
    return _classify(spark, sf_dir, "reference")


@register("f11_classify_contiguous", _classified("contiguous"))
def classified_contiguous(spark, sf_dir):
    return _classify(spark, sf_dir, "contiguous")


_SEVERITY = "CASE WHEN aqi >= 200 THEN 'severe' WHEN aqi >= 150 THEN 'warning' END"


@register("p10_f12_alerts", comparable_sql(
    f"SELECT station, datetime AS target_datetime, '24h' AS horizon, {_SEVERITY} AS severity, aqi AS value, "
    f"{case_sql('aqi', 2)} AS category, "
    "CASE WHEN aqi >= 200 THEN 'Severe alert' ELSE 'Warning' END || ': AQI forecast for 24h is ' || CAST(aqi AS VARCHAR) || ' (' || "
    f"{case_sql('aqi', 2)} || '). ' || {case_sql('aqi', 4)} AS message "
    f"FROM ({_ONE_DIGIT_SQL}) AS v WHERE aqi >= 150",
    "station target_datetime horizon severity category message", "value"))
def alert_rows(spark, sf_dir):
    forecasts = sparse_obs(spark, sf_dir).select(
        "station", F.col("datetime").alias("target_datetime"), F.lit(24).alias("horizon_hours"),
        round_half_even(F.col("us_aqi"), 1).alias("predicted_aqi"))
    return comparable(Q.alerts(forecasts))


@register("f17_round_half_even", comparable_sql(
    f"SELECT station, datetime, round_even(us_aqi, 1) AS one, round_even(us_aqi, 2) AS two, round_even(us_aqi, 3) AS three "
    f"FROM ({AQI_SQL}) AS o", "station datetime", "one two three"))
def rounded(spark, sf_dir):
    aqi = F.col("us_aqi")
    return comparable(obs(spark, sf_dir, ["us_aqi"]).select(
        "station", "datetime", round_half_even(aqi, 1).alias("one"), round_half_even(aqi, 2).alias("two"),
        round_half_even(aqi, 3).alias("three")))
