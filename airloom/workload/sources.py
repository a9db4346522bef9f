"""Scans, request plans and joins."""

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators.clean import (
    clean, deduplicate, duplicate_count, missing_counts, missing_hours, negative_counts,
)
from ..operators.recent import latest_row, latest_time, recent
from ..schema import POINT_COLUMNS
from ..session import new_path
from ..sources import landing, requests, store
from .catalog import comparable, comparable_sql, register
from .sql import cleaned_obs_sql
from .views import POINTS_SQL, obs, obs_sql, points, table
from .windows import COPIES_SQL, cleaned, copies

AIR = ["us_aqi", "pm2_5", "pm10"]
WEATHER = ["temperature_2m", "precipitation", "wind_speed_10m", "wind_direction_10m"]
DIMENSIONS = "station datetime"


# --- sources ----------------------------------------------------------------------------------

@register("s1_payload_landing_scan", comparable_sql(obs_sql(AIR), DIMENSIONS, AIR))
def payload_scan(spark, sf_dir):
    """Write the observations as payload files, then read them back as rows."""
    path = new_path(spark, "landing")
    landing.to_payloads(obs(spark, sf_dir, AIR), AIR).write.json(path)
    return comparable(landing.read_payloads(spark, path, AIR))


@register("f20_payload_text_parse", comparable_sql(obs_sql(AIR), DIMENSIONS, AIR))
def payload_parse(spark, sf_dir):
    payloads = landing.to_payloads(obs(spark, sf_dir, AIR), AIR)
    texts = payloads.select(F.to_json(F.struct("station", "hourly")).alias("text"))
    return comparable(landing.parse_payloads(texts, F.col("text"), AIR))


def ranges(spark, sf_dir):
    """First and last ship day of every supplier."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("station")).agg(
        F.to_date(F.min("l_shipdate")).alias("start_date"), F.to_date(F.max("l_shipdate")).alias("end_date"))


def chunks_sql(start: str) -> str:
    return (
        "SELECT station, CAST(chunk_start AS TIMESTAMP) AS chunk_start, "
        "least(chunk_start + INTERVAL 89 DAY, CAST(end_date AS TIMESTAMP)) AS chunk_end FROM ("
        "SELECT station, end_date, unnest(generate_series(start_date, end_date, INTERVAL 90 DAY)) AS chunk_start "
        f"FROM (SELECT l_suppkey AS station, {start} AS start_date, CAST(max(l_shipdate) AS DATE) AS end_date "
        "FROM lineitem GROUP BY 1) AS r WHERE start_date <= end_date) AS c")


@register("s2_date_chunks", chunks_sql("CAST(min(l_shipdate) AS DATE)"))
def chunks(spark, sf_dir):
    return comparable(requests.date_chunks(ranges(spark, sf_dir)))


FIRST_DATE = "1997-08-01"


@register("s3_source_availability_clamp", chunks_sql(f"greatest(CAST(min(l_shipdate) AS DATE), DATE '{FIRST_DATE}')"))
def clamped_chunks(spark, sf_dir):
    return comparable(requests.date_chunks(requests.clamp_start(ranges(spark, sf_dir), FIRST_DATE)))


@register("s3_available_rows", comparable_sql(obs_sql(["us_aqi"]), DIMENSIONS, "us_aqi")
          + f" WHERE datetime >= TIMESTAMP '{FIRST_DATE}'")
def available_rows(spark, sf_dir):
    return comparable(requests.available(obs(spark, sf_dir, ["us_aqi"]), FIRST_DATE))


PLACES_SQL = (
    "SELECT n_name AS name, c_mktsegment AS country, c_acctbal / 200 AS latitude, "
    "c_acctbal / 100 + 1 AS longitude, c_custkey AS rank FROM customer JOIN nation ON c_nationkey = n_nationkey")
REQUESTS_SQL = "SELECT lower(n_name) AS request FROM nation UNION ALL SELECT r_name AS request FROM region"


def places(spark, sf_dir):
    """Customers as places named after their nation: many candidates for every name."""
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("name"), F.col("c_mktsegment").alias("country"),
                (F.col("c_acctbal") / 200).alias("latitude"), (F.col("c_acctbal") / 100 + 1).alias("longitude"),
                F.col("c_custkey").alias("rank")))


def place_requests(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("request"))
    return nations.unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("request")))


@register("s5_geocode_first_match", comparable_sql(
    "SELECT request, name, country, latitude, longitude, row_number() OVER (PARTITION BY request ORDER BY rank) AS rn "
    f"FROM ({REQUESTS_SQL}) AS q JOIN ({PLACES_SQL}) AS p ON lower(request) = lower(name)",
    "request name country", "latitude longitude") + " WHERE rn = 1")
def geocoded(spark, sf_dir):
    return comparable(requests.geocode(place_requests(spark, sf_dir), places(spark, sf_dir)))


@register("s5_geocode_not_found",
          f"SELECT request, 'no place is called ' || request AS error FROM ({REQUESTS_SQL}) AS q "
          f"WHERE lower(request) NOT IN (SELECT lower(name) FROM ({PLACES_SQL}) AS p)")
def not_geocoded(spark, sf_dir):
    return requests.not_found(place_requests(spark, sf_dir), places(spark, sf_dir))


_LAT, _BRG, _ARC = "radians(s_acctbal / 200)", "radians(bearing_deg)", "(50.0 / 6371.0)"
_REACHED = f"asin(sin({_LAT}) * cos({_ARC}) + cos({_LAT}) * sin({_ARC}) * cos({_BRG}))"


@register("s6_j7_f7_spatial_sample_points", comparable_sql(
    f"SELECT s_suppkey AS station, bearing, bearing_deg, degrees({_REACHED}) AS point_latitude, "
    f"degrees(radians(s_acctbal / 100) + atan2(sin({_BRG}) * sin({_ARC}) * cos({_LAT}), "
    f"cos({_ARC}) - sin({_LAT}) * sin({_REACHED}))) AS point_longitude "
    "FROM supplier CROSS JOIN (VALUES ('N', 0.0), ('E', 90.0), ('S', 180.0), ('W', 270.0)) AS b(bearing, bearing_deg)",
    "station bearing", "bearing_deg point_latitude point_longitude"))
def spatial_points(spark, sf_dir):
    stations = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("station"), (F.col("s_acctbal") / 200).alias("latitude"),
        (F.col("s_acctbal") / 100).alias("longitude"))
    return comparable(requests.sample_points(stations))


@register("s7_csv_scan", comparable_sql(obs_sql(AIR), DIMENSIONS, AIR))
def csv_scan(spark, sf_dir):
    path = new_path(spark, "csv")
    store.write_csv(obs(spark, sf_dir, AIR), path)
    return comparable(landing.read_csv(spark, path, AIR))


_RECENT_SQL = (f"SELECT * FROM (SELECT *, max(datetime) OVER (PARTITION BY station) AS latest FROM ({obs_sql(AIR)}) AS o) "
               "AS w WHERE datetime >= latest - INTERVAL 45 DAY")


@register("s9_recent_rows_per_station", comparable_sql(_RECENT_SQL, DIMENSIONS, AIR))
def recent_rows(spark, sf_dir):
    return comparable(recent(obs(spark, sf_dir, AIR), "45 days"))


AS_OF = "2001-11-10"


@register("s9_recent_rows_with_fallback", comparable_sql(
    f"SELECT * FROM (SELECT *, max(datetime) OVER (PARTITION BY station) AS latest FROM ({obs_sql(AIR)}) AS o) AS w "
    f"WHERE datetime >= TIMESTAMP '{AS_OF}' - INTERVAL 12 DAY OR latest < TIMESTAMP '{AS_OF}' - INTERVAL 12 DAY",
    DIMENSIONS, AIR))
def recent_rows_fallback(spark, sf_dir):
    return comparable(recent(obs(spark, sf_dir, AIR), "12 days", AS_OF))


# --- projections ------------------------------------------------------------------------------

@register("p1_project_and_rename", comparable_sql(
    f"SELECT station, datetime AS time, us_aqi AS us_aqi_dir_N, pm2_5 AS pm2_5_dir_N FROM ({obs_sql(AIR)}) AS o",
    "station time", "us_aqi_dir_N pm2_5_dir_N"))
def renamed(spark, sf_dir):
    return comparable(obs(spark, sf_dir, AIR).withColumnsRenamed(
        {"datetime": "time", "us_aqi": "us_aqi_dir_N", "pm2_5": "pm2_5_dir_N"}).drop("pm10"))


# --- joins ------------------------------------------------------------------------------------

RETURNED = "l_returnflag = 'R'"
_JOIN_SQL = (f"SELECT w.*, a.us_aqi, a.pm2_5, a.pm10 FROM ({obs_sql(WEATHER)}) AS w JOIN ({obs_sql(AIR, RETURNED)}) AS a "
             "ON w.station = a.station AND w.datetime = a.datetime")


@register("j1_weather_air_quality_join", comparable_sql(_JOIN_SQL, DIMENSIONS, WEATHER + AIR))
def weather_air(spark, sf_dir):
    return comparable(J.join_sources(obs(spark, sf_dir, WEATHER), obs(spark, sf_dir, AIR, RETURNED)))


WIDE_POINTS_SQL = "SELECT station, datetime, " + ", ".join(
    f"max(CASE WHEN bearing = '{c[-1]}' THEN {c[:-6]} END) AS {c}" for c in POINT_COLUMNS
) + f" FROM ({POINTS_SQL}) AS p GROUP BY 1, 2"


@register("j2_spatial_points_wide", comparable_sql(WIDE_POINTS_SQL, DIMENSIONS, POINT_COLUMNS))
def wide_points(spark, sf_dir):
    return comparable(J.widen_points(points(spark, sf_dir)))


@register("j2_spatial_points_full_outer", comparable_sql(WIDE_POINTS_SQL, DIMENSIONS, POINT_COLUMNS))
def outer_points(spark, sf_dir):
    return comparable(J.outer_join_points(points(spark, sf_dir)))


@register("j3_attach_spatial_points", comparable_sql(
    f"SELECT o.*, {', '.join('p.' + c for c in POINT_COLUMNS)} FROM ({obs_sql(AIR, RETURNED)}) AS o "
    f"LEFT JOIN ({WIDE_POINTS_SQL}) AS p ON o.station = p.station AND o.datetime = p.datetime",
    DIMENSIONS, AIR + POINT_COLUMNS))
def attached_points(spark, sf_dir):
    wide = J.widen_points(points(spark, sf_dir))
    return comparable(J.attach_points(obs(spark, sf_dir, AIR, RETURNED), wide))


@register("j5_feature_label_recombination", comparable_sql(
    f"SELECT station, datetime, wind_speed_10m, us_aqi FROM ({obs_sql(['wind_speed_10m', 'us_aqi'])}) AS o",
    DIMENSIONS, "wind_speed_10m us_aqi"))
def recombined(spark, sf_dir):
    return comparable(J.recombine(obs(spark, sf_dir, ["wind_speed_10m"]), obs(spark, sf_dir, ["us_aqi"])))


_GRID = "unnest(generate_series(first, last, INTERVAL 1 DAY))"
_GAPS_SQL = (
    f"SELECT station, datetime FROM (SELECT station, {_GRID} AS datetime FROM (SELECT station, min(datetime) AS first, "
    f"max(datetime) AS last FROM ({obs_sql(AIR)}) AS o GROUP BY 1) AS r) AS e "
    f"EXCEPT SELECT station, datetime FROM ({obs_sql(AIR)}) AS o")


@register("j8_u3_missing_steps", _GAPS_SQL)
def gaps(spark, sf_dir):
    return missing_hours(obs(spark, sf_dir, AIR), "1 day")


@register("j8_missing_event_hours",
          "SELECT station, datetime FROM (SELECT station, unnest(generate_series(first, last, INTERVAL 1 HOUR)) AS datetime "
          "FROM (SELECT user_id AS station, min(date_trunc('hour', ts)) AS first, max(date_trunc('hour', ts)) AS last "
          "FROM events GROUP BY 1) AS r) AS e EXCEPT SELECT user_id AS station, date_trunc('hour', ts) AS datetime FROM events")
def event_gaps(spark, sf_dir):
    hours = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("station"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"))
    return missing_hours(hours)


# --- set operations, counts, latest -------------------------------------------------------------

@register("u1_union_of_chunks", comparable_sql(obs_sql(AIR), DIMENSIONS, AIR))
def chunk_union(spark, sf_dir):
    """Two date ranges written as separate payload folders, read as one scan."""
    path, cut = new_path(spark, "chunks"), F.lit("1998-01-01").cast("timestamp_ntz")
    rows = obs(spark, sf_dir, AIR)
    landing.to_payloads(rows.filter(F.col("datetime") < cut), AIR).write.json(f"{path}/chunk=1")
    landing.to_payloads(rows.filter(F.col("datetime") >= cut), AIR).write.json(f"{path}/chunk=2")
    return comparable(landing.read_payloads(spark, path, AIR))


_LATER_SQL = "SELECT station, datetime, us_aqi FROM (SELECT *, row_number() OVER (PARTITION BY station, datetime ORDER BY ingest_seq DESC) AS rn "


@register("u2_later_rows_win", comparable_sql(
    f"{_LATER_SQL} FROM ({COPIES_SQL}) AS u) AS r WHERE rn = 1", DIMENSIONS, "us_aqi"))
def later_wins(spark, sf_dir):
    return comparable(deduplicate(copies(spark, sf_dir), "ingest_seq", keep="last").drop("ingest_seq"))


@register("a10_duplicate_key_count",
          "SELECT CAST(count(*) - count(DISTINCT (station, datetime)) AS BIGINT) AS duplicate_rows FROM "
          "(SELECT l_suppkey AS station, l_shipdate AS datetime FROM lineitem) AS l")
def duplicates(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station"), F.col("l_shipdate").alias("datetime"))
    return duplicate_count(keys)


CELLS = ["us_aqi", "pm2_5", "pm10", "dew_point_2m", "cloud_cover_high"]


def _missing_sql(body: str) -> str:
    return ("SELECT CAST(" + " + ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in CELLS)
            + f" AS BIGINT) AS missing_cells FROM ({body}) AS o")


@register("a11_missing_cells_before_and_after",
          f"SELECT 'before' AS moment, missing_cells FROM ({_missing_sql(obs_sql(CELLS))}) AS b UNION ALL "
          f"SELECT 'after' AS moment, missing_cells FROM ({_missing_sql(cleaned_obs_sql(CELLS))}) AS a")
def missing_cells(spark, sf_dir):
    raw = obs(spark, sf_dir, CELLS)
    before = missing_counts(raw, CELLS).withColumn("moment", F.lit("before"))
    after = missing_counts(clean(raw, CELLS), CELLS).withColumn("moment", F.lit("after"))
    return before.unionByName(after)


@register("a12_negative_value_counts", "SELECT variable, CAST(negative_count AS BIGINT) AS negative_count FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, coalesce(sum(CASE WHEN {c} < 0 THEN 1 END), 0) AS negative_count FROM ({obs_sql(['precipitation', *AIR])}) AS o"
    for c in ["precipitation", *AIR]) + ") AS n")
def negatives(spark, sf_dir):
    return negative_counts(obs(spark, sf_dir, ["precipitation", *AIR]))


@register("f10_clip_at_zero", comparable_sql(
    f"SELECT station, datetime, CASE WHEN precipitation < 0 THEN 0 ELSE precipitation END AS precipitation, temperature_2m "
    f"FROM ({obs_sql(['precipitation', 'temperature_2m'])}) AS o", DIMENSIONS, "precipitation temperature_2m"))
def clipped(spark, sf_dir):
    return comparable(cleaned(spark, sf_dir, ["precipitation", "temperature_2m"])[0])


@register("a13_latest_timestamp", "SELECT l_suppkey AS station, max(date_trunc('day', l_shipdate)) AS latest FROM lineitem GROUP BY 1")
def latest_times(spark, sf_dir):
    return latest_time(obs(spark, sf_dir, ["us_aqi"]))


@register("t2_latest_row", comparable_sql(
    f"SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn FROM ({obs_sql(AIR)}) AS o",
    DIMENSIONS, AIR) + " WHERE rn = 1")
def latest_rows(spark, sf_dir):
    return comparable(latest_row(obs(spark, sf_dir, AIR)))


@register("f19_strip_zone_label", "SELECT event_id, ts AS datetime FROM events")
def stripped_zone(spark, sf_dir):
    """Read the naive timestamps as zoned ones, then drop the label: the value must not move."""
    from ..functions.scalars import strip_zone
    zoned = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("datetime"))
    return zoned.select("event_id", strip_zone(F.col("datetime")).alias("datetime"))
