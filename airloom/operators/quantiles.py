"""Exact interpolated quantiles of groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task. Here a bounded
sketch (``percentile_approx``) first brackets each wanted rank; only rows inside the brackets are
then ranked, and rows below them are counted. The sketch's rank error is at most n/accuracy, so
brackets of three times that hold the rank; a rank outside its bracket stops the job. Three
exchanges: the sketch, the counts by value, and the few counted values by group.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame, groups: list[str], value: str, probs: list[float], accuracy: int = ACCURACY,
    few_groups: bool = False,
) -> DataFrame:
    """One row per group: ``groups``, ``n``, ``min``, ``max`` and ``quantiles`` (array, by prob).

    ``few_groups``: the caller knows that the number of groups is small and fixed (months,
    pollutants), so the brackets may be broadcast; otherwise Spark picks the join by size."""
    if not groups:
        whole = exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs, accuracy, True)
        return whole.drop("_all")
    rows = df.select(*groups, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    margin = 3.0 / accuracy
    bounds = [b for p in probs for b in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = rows.groupBy(*groups).agg(
        F.count("*").alias("n"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        F.percentile_approx("_v", bounds, accuracy).alias("_cuts"))
    # In a small group the margin is less than a few ranks: rank the whole group. At the ends of
    # the range there is nothing to cut off.
    small_group = F.col("n") < 4 * accuracy

    def open_low(p):
        return small_group | F.lit(p - margin <= 0)

    def open_high(p):
        return small_group | F.lit(p + margin >= 1)

    brackets = sketch.select(*groups, *[
        c for i, p in enumerate(probs) for c in (
            F.when(open_low(p), F.col("min")).otherwise(F.col("_cuts")[2 * i]).alias(f"_low{i}"),
            F.when(open_high(p), F.col("max")).otherwise(F.col("_cuts")[2 * i + 1]).alias(f"_high{i}"))])
    joined = rows.join(F.broadcast(brackets) if few_groups else brackets, [rows[g].eqNullSafe(brackets[g]) for g in groups])
    for g in groups:
        joined = joined.drop(brackets[g])
    each = range(len(probs))
    inside = reduce(or_, [F.col("_v").between(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in each])
    # rows outside all brackets collapse into one row per task, which counts those below each bracket
    counted = joined.groupBy(*groups, F.when(inside, F.col("_v")).alias("_value")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("min"), F.max("_v").alias("max"),
        *[F.count_if(F.col("_v") < F.col(f"_low{i}")).alias(f"_below{i}") for i in each],
        *[F.max(f"_{end}{i}").alias(f"_{end}{i}") for i in each for end in ("low", "high")])  # equal in a group
    group = Window.partitionBy(*groups)
    by_value = group.orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, 0)
    ends = counted.withColumns({
        "_n": F.sum("_c").over(group),
        # the rows in other brackets below this one come before it by their value
        **{f"_upto{i}": F.sum(F.when(F.col("_value").isNull(), F.col(f"_below{i}")).otherwise(F.col("_c"))).over(by_value)
           for i in each}})

    def quantile(i: int, p: float):
        rank = F.lit(p) * (F.col("_n") - 1)

        def at(wanted):
            here = (F.col(f"_upto{i}") - F.col("_c") <= wanted) & (wanted < F.col(f"_upto{i}"))
            return F.max(F.when(F.col("_value").between(F.col(f"_low{i}"), F.col(f"_high{i}")) & here, F.col("_value")))

        lower, upper = at(F.floor(rank)), at(F.ceil(rank))
        found = lower + (upper - lower) * F.max(rank - F.floor(rank))
        return F.coalesce(found, F.raise_error(F.lit("rank outside its bracket")).cast("double"))

    quantiles = F.array(*[quantile(i, p) for i, p in enumerate(probs)])
    return ends.groupBy(*groups).agg(
        F.sum("_c").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), quantiles.alias("quantiles"))


def box_stats(df: DataFrame, groups: list[str], value: str, few_groups: bool = False) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 IQR of the box), min, max, count."""
    q = exact_quantiles(df, groups, value, [0.25, 0.5, 0.75], few_groups=few_groups).select(
        *groups, "n", "min", "max", F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    limits = q.select(*groups, (F.col("q1") - reach).alias("_lo"), (F.col("q3") + reach).alias("_hi"))
    whiskers = df.join(F.broadcast(limits) if few_groups else limits, groups).groupBy(*groups).agg(
        F.min(F.when(F.col(value) >= F.col("_lo"), F.col(value))).alias("lower_whisker"),
        F.max(F.when(F.col(value) <= F.col("_hi"), F.col(value))).alias("upper_whisker"))
    return q.join(whiskers, groups)
