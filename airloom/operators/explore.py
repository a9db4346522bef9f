"""Exploratory aggregates."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import month_name
from ..schema import DISTRIBUTION_POLLUTANTS, TARGET
from .clean import numeric_columns
from .quantiles import box_stats

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # functions travel to the workers whole

UNHEALTHY_ABOVE = 150


def summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, time range, last reading, mean, max, min, percent above 150 (missing counts as not)."""
    aqi = F.col(TARGET)
    known_time = F.when(aqi.isNotNull(), F.col("datetime"))
    return df.groupBy(*(by if by is not None else ["station"])).agg(
        F.count("*").alias("rows"),
        F.min("datetime").alias("first_datetime"), F.max("datetime").alias("last_datetime"),
        F.max_by(aqi, known_time).alias("current_aqi"),
        F.bround(F.avg(aqi), 1).alias("mean_aqi"),
        F.bround(F.max(aqi), 1).alias("max_aqi"),
        F.bround(F.min(aqi), 1).alias("min_aqi"),
        F.bround(unhealthy_share(), 1).alias("pct_unhealthy_or_worse"),
    )


def unhealthy_share():
    return F.avg(F.when(F.col(TARGET) > UNHEALTHY_ABOVE, 1).otherwise(0)) * 100


def daily_mean(df: DataFrame) -> DataFrame:
    """Mean per station and calendar day; days without rows between the first and last get null.
    The gaps come from each day's successor, on the small daily table."""
    day = F.to_date("datetime")
    daily = df.groupBy("station", day.alias("date")).agg(F.avg(TARGET).alias("mean_aqi"))
    following = F.lead("date").over(Window.partitionBy("station").orderBy("date"))
    reach = F.coalesce(F.date_sub(following, 1), F.col("date"))
    spread = daily.withColumn("_until", reach).select(
        "station", F.col("date").alias("_date"), "mean_aqi",
        F.explode(F.sequence("date", "_until")).alias("date"))
    return spread.select("station", "date", F.when(F.col("date") == F.col("_date"), F.col("mean_aqi")).alias("mean_aqi"))


def mean_by_hour(df: DataFrame) -> DataFrame:
    return df.groupBy(F.hour("datetime").alias("hour")).agg(F.avg(TARGET).alias("mean_aqi"))


def by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(F.month("datetime").alias("month")).agg(
        F.avg(TARGET).alias("mean_aqi"), F.min(TARGET).alias("min_aqi"), F.max(TARGET).alias("max_aqi"))


def monthly_distribution(df: DataFrame) -> DataFrame:
    """Box statistics per month of the year, with the month's name."""
    months = df.select(F.month("datetime").alias("month"), month_name(F.col("datetime")).alias("month_name"), TARGET)
    return box_stats(months, ["month", "month_name"], TARGET, few_groups=True)


def pollutant_distribution(df: DataFrame) -> DataFrame:
    cols = [c for c in DISTRIBUTION_POLLUTANTS if c in df.columns]
    long = df.select(*cols).unpivot([], cols, "pollutant", "reading")
    return box_stats(long, ["pollutant"], "reading", few_groups=True)


def correlations(df: DataFrame, target: str = TARGET, cols: list[str] | None = None) -> DataFrame:
    """Absolute Pearson correlation of every numeric column with the target, over pairs where both
    are present, with its rank. One pass; the result has one row per column."""
    cols = cols or numeric_columns(df)
    one_row = df.agg(*[F.abs(F.corr(c, target)).alias(c) for c in cols])
    long = one_row.unpivot([], cols, "column", "abs_corr")
    strongest = Window.partitionBy(F.lit(1)).orderBy(F.desc_nulls_last("abs_corr"), "column")
    return long.withColumn("rank", F.row_number().over(strongest))


def top_correlated(df: DataFrame, n: int = 15, target: str = TARGET, cols: list[str] | None = None) -> DataFrame:
    return correlations(df, target, cols).orderBy("rank").limit(n)


def correlation_matrix(df: DataFrame, n: int = 15, target: str = TARGET, cols: list[str] | None = None) -> DataFrame:
    """Pairwise correlations (over rows where both are present) of the ``n`` columns closest to the
    target, long form. One pass ranks the columns (``n`` names come back), another adds up the moments of all
    pairs: as matrices in each task, which took a third of the time of one aggregate of 120 correlations at sf0.1."""
    names = [r["column"] for r in top_correlated(df, n, target, cols).collect()]
    size = len(names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
                moments = pair_moments(x, known)
                total = moments if total is None else merged_moments(total, moments)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["moments"])

    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    parts = numbers.mapInArrow(add_up, "moments array<double>").collect()  # a few matrices a task
    moments = np.zeros((4, size, size))
    for part in parts:
        moments = merged_moments(moments, np.array(part.moments).reshape(4, size, size))
    _, _, squares, products = moments
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = products / np.sqrt(squares * squares.T)
    flat = (squares == 0) | (squares.T == 0)  # no rows, or a column that does not vary
    cells = [(a, b, None if flat[i, j] else float(corr[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return df.sparkSession.createDataFrame(cells, "column_a string, column_b string, corr double")


def pair_moments(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Over the rows where both columns of a pair are known: rows, mean of the first, its squared deviations, and
    the products of both deviations (4 x columns x columns). A pair with a NaN or an infinity has NaN deviations."""
    finite = known & np.isfinite(np.where(known, x, 0.0))
    one, plain = known.astype(float), np.where(finite, x, 0.0)
    centre = plain.sum(axis=0) / np.maximum(finite.sum(axis=0), 1)
    low, high = np.where(finite, x, np.inf).min(axis=0), np.where(finite, x, -np.inf).max(axis=0)
    centre = np.where(low == high, low, centre)  # a column that does not vary has deviations of exactly 0
    y = np.where(finite, x - centre, 0.0)
    n, s = one.T @ one, y.T @ one
    mean = s / np.maximum(n, 1)
    odd = (known & ~finite).astype(float)
    odd = odd.T @ one + one.T @ odd > 0
    squares, products = np.maximum((y * y).T @ one - s * mean, 0), y.T @ y - s * mean.T
    return np.stack([n, mean + centre[:, None], np.where(odd, np.nan, squares), np.where(odd, np.nan, products)])


def merged_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two parts of the rows together (Chan, Golub and LeVeque)."""
    n = a[0] + b[0]
    share, apart = b[0] / np.maximum(n, 1), b[1] - a[1]
    apart = np.where((a[0] > 0) & (b[0] > 0), apart, 0.0)
    both = a[0] * share
    mean = np.where(a[0] > 0, a[1] + apart * share, b[1])
    return np.stack([n, mean, a[2] + b[2] + apart * apart * both, a[3] + b[3] + apart * apart.T * both])
