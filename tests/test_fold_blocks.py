"""Fold numbers of wide rows: the hours travel, the rows stay."""

from pyspark.sql import functions as F

from airloom.plans import training as T


def test_wide_rows_are_not_dealt_anew(spark):
    rows = spark.range(2_000).select(
        (F.col("id") % 5).alias("station"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + (F.col("id") / 5).cast("int") * F.expr("INTERVAL 1 HOUR")).alias("datetime"),
        *[F.rand(i).alias(f"c{i}") for i in range(30)])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # however little the planner expects
    try:
        blocks = T.pooled_cv_blocks(rows)
        plan = blocks._jdf.queryExecution().executedPlan().toString()
        counts = {r["cv_block"]: r["count"] for r in blocks.groupBy("cv_block").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert counts == {i: 500 for i in range(4)}
