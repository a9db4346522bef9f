"""Row-ordered work per station that holds up when one station has most of the rows.

A window over ``station`` puts a station's whole history in one task. That is the cheapest plan
while histories are short, so the row counts are checked first. Stations above the limit ("hot")
are numbered and cut into blocks of consecutive rows; each block also gets copies of the rows
around it that its frames reach, so every block can be computed on its own.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_ROWS_SETTING = "airloom.maxStationRows"
DEFAULT_MAX_ROWS = 1_000_000
MAX_LISTED = 10_000

HELPERS = ["_chunk", "_block", "_own", "_pos"]


def max_station_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_ROWS_SETTING, str(DEFAULT_MAX_ROWS)))


@dataclass(frozen=True)
class HotStations:
    """Stations too long for one task. ``every`` means: too many to list, treat all as hot. ``rows``: of all stations,
    where they were counted."""

    stations: tuple = ()
    every: bool = False
    rows: int | None = None

    @property
    def none(self) -> bool:
        return not self.every and not self.stations

    def _is_hot(self) -> Column:
        return F.coalesce(F.col("station").isin(list(self.stations)), F.lit(False))

    def pick(self, df: DataFrame) -> DataFrame:
        return df if self.every else df.filter(self._is_hot())

    def rest(self, df: DataFrame) -> DataFrame:
        return df.filter(~self._is_hot())

    def apply(self, df: DataFrame, plain: Callable, blocked: Callable) -> DataFrame:
        """``plain`` on ordinary stations, ``blocked`` on hot ones."""
        if self.none:
            return plain(df)
        if self.every:
            return blocked(df)
        return plain(self.rest(df)).unionByName(blocked(self.pick(df)))


def find_hot_stations(df: DataFrame) -> HotStations:
    """Count rows per station (partial aggregation, one column read) and list those over the limit."""
    limit = max_station_rows(df.sparkSession)
    counted = df.groupBy("station").agg(F.count("*").alias("n"))
    rows, over = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > limit)).first()
    if not over or over > MAX_LISTED:
        return HotStations(every=over > MAX_LISTED, rows=rows)
    listed = counted.filter(F.col("n") > limit).select("station").collect()
    return HotStations(tuple(r.station for r in listed), rows=rows)


def with_chunk(df: DataFrame) -> DataFrame:
    """Hour of the row: at most the hours of the calendar per station, whatever the row rate."""
    return df.withColumn("_chunk", F.date_trunc("hour", F.col("datetime")))


def number_hot(df: DataFrame) -> DataFrame:
    """0-based row position per station: rank inside the hour plus the rows of earlier hours."""
    chunked = with_chunk(df)
    earlier = (Window.partitionBy("station").orderBy("_chunk")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        chunked.groupBy("station", "_chunk").agg(F.count("*").alias("_n"))
        .select("station", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("station", "_chunk").orderBy("datetime")
    return (
        chunked.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, ["station", "_chunk"])
        .withColumn("_pos", F.col("_start") + F.col("_rank"))
        .drop("_rank", "_start")
    )


def number_plain(df: DataFrame) -> DataFrame:
    by_time = Window.partitionBy("station").orderBy("datetime")
    return df.withColumn("_pos", F.row_number().over(by_time).cast("bigint") - 1)


def with_position(df: DataFrame, hot: HotStations | None = None) -> DataFrame:
    """Chronological row index per station as ``_pos``."""
    hot = hot or find_hot_stations(df)
    return hot.apply(df, number_plain, lambda d: number_hot(d).drop("_chunk"))


def cut_into_blocks(df: DataFrame, before: int, after: int) -> DataFrame:
    """Blocks of consecutive positions; edge rows are copied to the neighbour that looks at them."""
    size = max(max_station_rows(df.sparkSession), before, after, 1)
    block = F.floor(F.col("_pos") / size)
    offset = F.col("_pos") - block * size

    def placed(to: Column, own: bool) -> Column:
        return F.struct(to.alias("_block"), F.lit(own).alias("_own"))

    places = F.array_compact(F.array(
        placed(block, True),
        F.when(offset >= size - before, placed(block + 1, False)),
        F.when((offset < after) & (block > 0), placed(block - 1, False)),
    ))
    return df.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")


def over_station(
    df: DataFrame, compute: Callable[[DataFrame, list[str]], DataFrame],
    before: int = 0, after: int = 0, hot: HotStations | None = None,
) -> DataFrame:
    """Run ``compute(df, partition_columns)``, whose windows look at most ``before`` rows back and
    ``after`` rows ahead in ``datetime`` order. ``(station, datetime)`` must be unique."""
    hot = hot or find_hot_stations(df)

    def blocked(part: DataFrame) -> DataFrame:
        ready = part if "_pos" in part.columns else number_hot(part)
        done = compute(cut_into_blocks(ready, before, after), ["station", "_block"])
        return done.filter("_own").drop(*HELPERS)

    return hot.apply(df, lambda d: compute(d, ["station"]), blocked)
