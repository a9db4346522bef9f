"""Regression metrics, scaler statistics and skill."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HORIZONS, TARGET


def regression_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """RMSE, MAE and R² in one pass. The spread of the truth comes from ``var_pop``, which merges
    centred sums; a constant truth has no R²."""
    y, p = F.col(truth), F.col(prediction)
    both = df.filter(y.isNotNull() & p.isNotNull())
    squared = F.avg((y - p) * (y - p))
    return both.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.lit(1.0) - F.try_divide(squared, F.var_pop(y))).alias("r2"),
    )


def persistence_metrics(df: DataFrame, by: list[str] = (), horizons=HORIZONS) -> DataFrame:
    """Baseline "the AQI stays as it is", for every horizon, from one scan."""
    cases = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_{TARGET}_{h}h_ahead").alias("truth"))
        for h in horizons])
    long = df.select(*by, TARGET, F.inline(cases))
    return regression_metrics(long, "truth", TARGET, [*by, "horizon"])


def scaler_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``mean`` and ``std`` maps by column. Population deviation; a constant column gets
    1 so that it scales to zero."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    means = [x for c in cols for x in (F.lit(c), F.col(f"m_{c}"))]
    stds = [x for c in cols for x in (F.lit(c), F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")))]
    return stats.select(F.create_map(*means).alias("mean"), F.create_map(*stds).alias("std"))


def scaled_columns(stats: DataFrame, cols: list[str]) -> dict[str, Column]:
    """Standardised columns. The statistics are one row with two numbers per column; they are read
    here and become constants of the plan."""
    row = stats.first()
    return {c: (F.col(c) - F.lit(row["mean"][c])) / F.lit(row["std"][c]) for c in cols}


def scale(df: DataFrame, stats: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns(scaled_columns(stats, cols))


def best_candidates(results: DataFrame) -> DataFrame:
    """Per horizon the candidate with the lowest cross-validation error; the test error plays no
    part. Ties go to the first name."""
    row = F.struct(*results.columns)
    order = F.struct("cv_rmse", "model")
    return results.groupBy("horizon").agg(F.min_by(row, order).alias("_row")).select("_row.*")


def evaluation_summary(best: DataFrame, baseline: DataFrame) -> DataFrame:
    """Best model per horizon beside the baseline, and the gain in R²."""
    base = baseline.select("horizon", F.col("r2").alias("_base"))
    return best.join(base, "horizon").select(
        F.concat(F.col("horizon").cast("string"), F.lit("h")).alias("horizon"),
        F.col("model").alias("best_model"),
        F.bround("test_rmse", 2).alias("test_rmse"), F.bround("test_mae", 2).alias("test_mae"),
        F.bround("test_r2", 3).alias("test_r2"), F.bround("_base", 3).alias("baseline_r2"),
        F.bround(F.col("test_r2") - F.col("_base"), 3).alias("r2_vs_baseline"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
