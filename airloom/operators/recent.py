"""Reads of recent rows per station."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_rows(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest rows of each station. The limit is also applied per map task before the
    shuffle (window group limit)."""
    newest = Window.partitionBy("station").orderBy(F.desc("datetime"))
    return df.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") <= n).drop("_nth")


def latest_row(df: DataFrame) -> DataFrame:
    """The latest row of each station, without a sort: only the newest row per task is shuffled."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy("station").agg(F.max_by(row, "datetime").alias("_row")).select("_row.*")


def latest_time(df: DataFrame) -> DataFrame:
    return df.groupBy("station").agg(F.max("datetime").alias("latest"))


def recent(df: DataFrame, lookback: str, as_of=None) -> DataFrame:
    """Rows of the last ``lookback`` (for example ``"45 days"``).

    With ``as_of`` the cutoff is a constant and reaches the scan as a partition and row-group
    filter; stations silent since then fall back to their own last row. Without it every station
    counts back from its own last row."""
    back = F.expr(f"INTERVAL {lookback}")
    latest = latest_time(df)
    if as_of is not None:
        cutoff = F.lit(as_of).cast("timestamp_ntz") - back
        fresh = df.filter(F.col("datetime") >= cutoff)
        silent = latest.filter(F.col("latest") < cutoff).select("station")
        return fresh.unionByName(df.join(silent, "station", "left_semi"))
    since = latest.select("station", (F.col("latest") - back).alias("_since"))
    return df.join(since, "station").filter(F.col("datetime") >= F.col("_since")).drop("_since")
