"""Hourly tumbling means of raw events, as a batch and as a stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _means(variables: dict[str, str]):
    return [F.avg(F.when(F.col("event_type") == e, F.col("value"))).alias(v) for v, e in variables.items()]


def hourly_means(events: DataFrame, variables: dict[str, str]) -> DataFrame:
    """Events (station, ts, event_type, value) to one row per station and hour. Partial sums are
    formed before the shuffle, so a station with most events costs no more than another."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime")
    return events.groupBy("station", hour).agg(*_means(variables))


def hourly_means_stream(
    events: DataFrame, variables: dict[str, str], lateness: str = "72 hours",
) -> DataFrame:
    """The same over a stream. Append output: an hour is emitted once the watermark has passed it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    hours = timed.groupBy("station", F.window("ts", "1 hour").alias("_hour")).agg(*_means(variables))
    return hours.select(
        "station", F.col("_hour.start").cast("timestamp_ntz").alias("datetime"), *variables)
