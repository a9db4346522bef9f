"""What to read: date chunks, place lookup and spatial sample points."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import destination
from ..schema import AIR_QUALITY_MIN_DATE, BEARINGS, CHUNK_DAYS, POINT_DISTANCE_KM


def date_chunks(ranges: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """(station, start_date, end_date) to inclusive chunks that do not overlap."""
    starts = F.sequence("start_date", "end_date", F.expr(f"INTERVAL {chunk_days} DAYS"))
    return (
        ranges.filter(F.col("start_date") <= F.col("end_date"))
        .select("station", "end_date", F.explode(starts).alias("chunk_start"))
        .select("station", "chunk_start",
                F.least(F.date_add("chunk_start", chunk_days - 1), "end_date").alias("chunk_end"))
    )


def clamp_start(ranges: DataFrame, first_date: str = AIR_QUALITY_MIN_DATE) -> DataFrame:
    """Raise the start to the first date the source has."""
    return ranges.withColumn("start_date", F.greatest("start_date", F.lit(first_date).cast("date")))


def available(df: DataFrame, first_date: str = AIR_QUALITY_MIN_DATE) -> DataFrame:
    return df.filter(F.col("datetime") >= F.lit(first_date).cast("timestamp_ntz"))


def _by_name(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("_key", F.lower(F.trim(name)))


def geocode(requests: DataFrame, places: DataFrame, order: str = "rank") -> DataFrame:
    """The first place (lowest ``order``) whose name matches, ignoring case. Candidates of a name
    are reduced before the shuffle, so a very common name stays cheap."""
    found = F.struct("name", "country", "latitude", "longitude")
    first = _by_name(places, "name").groupBy("_key").agg(F.min_by(found, order).alias("_place"))
    return _by_name(requests, "request").join(first, "_key").select("request", "_place.*")


def not_found(requests: DataFrame, places: DataFrame) -> DataFrame:
    """Requests without any match, with the error text."""
    names = _by_name(places, "name").select("_key").distinct()
    return _by_name(requests, "request").join(names, "_key", "left_anti").select(
        "request", F.concat(F.lit("no place is called "), "request").alias("error"))


def sample_points(
    stations: DataFrame, bearings: dict = BEARINGS, distance_km: float = POINT_DISTANCE_KM,
) -> DataFrame:
    """Every station with every bearing and the point that lies ``distance_km`` that way. The
    bearings are a literal array on each row, not a second table."""
    all_bearings = F.array(*[
        F.struct(F.lit(n).alias("bearing"), F.lit(float(d)).alias("bearing_deg")) for n, d in bearings.items()])
    spread = stations.select("*", F.inline(all_bearings))
    lat, lon = destination(F.col("latitude"), F.col("longitude"), F.col("bearing_deg"), distance_km)
    return spread.select("station", "bearing", "bearing_deg",
                         lat.alias("point_latitude"), lon.alias("point_longitude"))
