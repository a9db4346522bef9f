"""Training-ready rows, the calendar-anchored split, and time-ordered folds."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import HotStations, find_hot_stations, with_position
from ..schema import EDGE_SENSITIVE

FOLDS = 3


def training_ready(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with full look-back and full look-ahead."""
    return df.na.drop(subset=columns or [c for c in EDGE_SENSITIVE if c in df.columns])


def warmed_up(df: DataFrame) -> DataFrame:
    return df.filter(F.col("aqi_rolling_mean_168h").isNotNull())


def first_test_time(df: DataFrame, step: str = "1 hour", months: int = 12):
    """First moment of the test period: the last time minus ``months`` plus one step."""
    last = F.max("datetime")
    return df.agg((last - F.expr(f"INTERVAL {months} MONTH") + F.expr(f"INTERVAL {step}")).alias("t")).first().t


def add_split(df: DataFrame, step: str = "1 hour", months: int = 12) -> DataFrame:
    """``split``: test is the last ``months`` calendar months, train is everything before. One
    boundary for all stations; it is read first, so that filters on it reach the scan."""
    start = F.lit(first_test_time(df, step, months)).cast("timestamp_ntz")
    return df.withColumn("split", F.when(F.col("datetime") < start, "train").otherwise("test"))


def split_bounds(df: DataFrame) -> DataFrame:
    """First and last time, rows and share of each split."""
    per_split = df.groupBy("split").agg(
        F.min("datetime").alias("first_datetime"), F.max("datetime").alias("last_datetime"),
        F.count("*").alias("rows"))
    whole = Window.partitionBy(F.lit(1))  # at most two rows
    return per_split.withColumn("share", F.col("rows") / F.sum("rows").over(whole))


def cv_blocks(df: DataFrame, folds: int = FOLDS, hot: HotStations | None = None) -> DataFrame:
    """``cv_block`` 0..folds per station: fold i trains on blocks below i and tests on block i."""
    hot = hot or find_hot_stations(df)
    counts = df.groupBy("station").agg(F.count("*").alias("_n"))
    test = F.greatest(F.expr(f"_n div {folds + 1}"), F.lit(1))
    behind = F.col("_pos") + 1 - (F.col("_n") - folds * F.expr(f"_n div {folds + 1}"))
    return (
        with_position(df, hot).join(counts, "station")
        .withColumn("cv_block", F.greatest(F.lit(0), F.ceil(behind / test)).cast("int"))
        .drop("_pos", "_n")
    )


def pooled_cv_blocks(df: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``cv_block`` 0..folds for one model over all stations: cut by time over all rows, so that no
    fold trains on a row later than its test rows. Rows of one hour share a block; for one station
    of hourly rows the blocks are those of :func:`cv_blocks`.

    The running count is over the hours of the calendar (8,766 a year), however many the rows: they are sent to
    the rows, which stay where they are."""
    hour = F.date_trunc("hour", F.col("datetime"))
    hours = df.groupBy(hour.alias("_hour")).agg(F.count("*").alias("_rows"))
    in_time = Window.partitionBy(F.lit(1)).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    counted = hours.withColumns({
        "_pos": F.coalesce(F.sum("_rows").over(in_time), F.lit(0)),
        "_n": F.sum("_rows").over(Window.partitionBy(F.lit(1)))})
    test = F.greatest(F.expr(f"_n div {folds + 1}"), F.lit(1))
    behind = F.col("_pos") + 1 - (F.col("_n") - folds * F.expr(f"_n div {folds + 1}"))
    block = F.greatest(F.lit(0), F.ceil(behind / test)).cast("int")
    return (
        df.withColumn("_hour", hour)
        .join(F.broadcast(counted.select("_hour", block.alias("cv_block"))), "_hour").drop("_hour"))


def order_violations(df: DataFrame, seq: str, chunk_rows: int = 1_000_000) -> DataFrame:
    """Per station: rows that arrived (by ``seq``) with an earlier time than the row before them.

    Arrivals are compared inside chunks of the sequence, and chunk to chunk by their end rows, so
    no task holds a whole station."""
    chunked = df.withColumn("_chunk", F.floor(F.col(seq) / chunk_rows))
    inside = Window.partitionBy("station", "_chunk").orderBy(seq)
    marked = chunked.withColumn("_back", F.col("datetime") < F.lag("datetime").over(inside))
    chunks = marked.groupBy("station", "_chunk").agg(
        F.count_if("_back").alias("_inside"),
        F.min_by("datetime", seq).alias("_first"), F.max_by("datetime", seq).alias("_last"))
    across = Window.partitionBy("station").orderBy("_chunk")
    return (
        chunks.withColumn("_between", (F.col("_first") < F.lag("_last").over(across)).cast("int"))
        .groupBy("station")
        .agg((F.sum("_inside") + F.coalesce(F.sum("_between"), F.lit(0))).alias("out_of_order"))
    )
