"""Observation tables derived from the given tables, as DataFrames and as SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import HotStations, find_hot_stations, max_station_rows
from ..schema import AIR_QUALITY_VARS, BEARINGS, WEATHER_VARS

# Variable -> aggregate over the line items of a supplier and ship day. Same text in both engines.
READINGS = {
    "temperature_2m": "avg(l_extendedprice) / 1999.37 - 10",
    "relative_humidity_2m": "min(l_quantity) * 2",
    "precipitation": "avg(l_tax) * 100 - 2",
    "pressure_msl": "avg(l_discount * l_discount) * 2000 + 1000",
    "cloud_cover": "min(l_discount) * 1000",
    "wind_speed_10m": "avg(l_discount) * 100",
    "wind_direction_10m": "CAST(sum(l_partkey) % 360 AS DOUBLE)",
    "dew_point_2m": "avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) - 5",
    "apparent_temperature": "min(l_extendedprice) / 1999.37 - 12",
    "vapour_pressure_deficit": "avg(l_tax) * 20",
    "wind_gusts_10m": "max(l_discount) * 200",
    "cloud_cover_low": "min(l_tax) * 1000",
    "cloud_cover_mid": "max(l_tax) * 1000",
    "cloud_cover_high": "avg(CASE WHEN l_returnflag = 'N' THEN l_quantity END) * 2",
    "surface_pressure": "max(l_tax) * 200 + 990",
    "pm10": "avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END) * 2.03710117",
    "pm2_5": "avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) * 1.01710337",
    "carbon_monoxide": "max(l_extendedprice) / 101.37117013",
    "nitrogen_dioxide": "avg(l_tax * l_quantity) * 101.37117013",
    "sulphur_dioxide": "max(l_quantity)",
    "ozone": "avg(l_discount * l_quantity) * 101.37117013",
    "us_aqi": "avg(l_quantity) * 6",
}
ALL_VARS = WEATHER_VARS + AIR_QUALITY_VARS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ITEMS_A_TASK = 100_000  #: line items that one task takes, so that its memory does not grow with the table
LEAST_ITEMS = 20_000  #: line items that are worth a task of their own


def station_tasks(spark: SparkSession, sf_dir: str) -> tuple[int | None, HotStations]:
    """In how many tasks whole stations fit, and the hot ones. A station has no more days than line items, so one count
    of these tells that none is hot. None: some are, and their line items must not meet in one task."""
    per_station = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    n, most = per_station.agg(F.sum("n"), F.max("n")).first()
    if n is None or most > max_station_rows(spark):
        return None, find_hot_stations(obs(spark, sf_dir, ["us_aqi"]))
    return max(1, min(spark.sparkContext.defaultParallelism, n // LEAST_ITEMS), n // ITEMS_A_TASK), HotStations()


def _placed(items: DataFrame, tasks: int | None) -> DataFrame:
    return items.repartition(tasks, "l_suppkey") if tasks else items


def obs(spark: SparkSession, sf_dir: str, variables: list[str] | None = None,
        where: str | None = None, tasks: int | None = None) -> DataFrame:
    """One row per supplier (station) and ship day. Unused readings are pruned by the optimizer. With ``tasks``
    (:func:`station_tasks`) a station's rows are in one task, where steps per station find them without an exchange."""
    items = table(spark, sf_dir, "lineitem")
    if where:
        items = items.filter(where)
    items = _placed(items, tasks)
    return (
        items.groupBy(F.col("l_suppkey").alias("station"),
                      F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("datetime"))
        .agg(*[F.expr(READINGS[v]).alias(v) for v in variables or ALL_VARS])
    )


def obs_sql(variables: list[str] | None = None, where: str | None = None) -> str:
    readings = ", ".join(f"{READINGS[v]} AS {v}" for v in variables or ALL_VARS)
    condition = f"WHERE {where} " if where else ""
    return (f"SELECT l_suppkey AS station, date_trunc('day', l_shipdate) AS datetime, {readings} "
            f"FROM lineitem {condition}GROUP BY 1, 2")


# Spatial points: the line number decides the bearing, so every line item feeds one of four points.
POINT_OF = " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(BEARINGS))
POINT_OF = f"CASE l_linenumber % 4 {POINT_OF} END"


def points(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Long form: station, datetime, bearing, pm2_5, us_aqi. ``tasks`` as in :func:`obs`."""
    return (
        _placed(table(spark, sf_dir, "lineitem"), tasks)
        .groupBy(F.col("l_suppkey").alias("station"),
                 F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("datetime"),
                 F.expr(POINT_OF).alias("bearing"))
        .agg(F.expr("avg(l_quantity) - 3").alias("pm2_5"), F.expr("avg(l_quantity) * 5").alias("us_aqi"))
    )


POINTS_SQL = (
    f"SELECT l_suppkey AS station, date_trunc('day', l_shipdate) AS datetime, {POINT_OF} AS bearing, "
    "avg(l_quantity) - 3 AS pm2_5, avg(l_quantity) * 5 AS us_aqi FROM lineitem GROUP BY 1, 2, 3"
)

HOURLY_EVENTS = {
    "us_aqi": "click", "pm2_5": "view", "pm10": "error", "wind_speed_10m": "purchase",
    "precipitation": "signup",
}
HOURLY_SQL = (
    "SELECT user_id % 4 AS station, date_trunc('hour', ts) AS datetime, "
    + ", ".join(f"avg(CASE WHEN event_type = '{e}' THEN value END) AS {v}" for v, e in HOURLY_EVENTS.items())
    + " FROM events GROUP BY 1, 2"
)
