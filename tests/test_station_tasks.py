"""Steps per station on rows that are placed once: tasks grow with the table."""

from pyspark.sql import functions as F

from airloom.operators import clean as C
from airloom.workload import views
from airloom.workload.windows import copies


def _items(spark, tmp_path, rows, stations):
    start = F.lit("2000-01-01").cast("timestamp")
    spark.range(rows).select(
        (F.col("id") % stations).alias("l_suppkey"), (start + F.expr("make_interval(0, 0, 0, cast(id div 7 as int))")).alias("l_shipdate"),
        F.col("id").cast("double").alias("l_quantity")).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_tasks_grow_with_the_items_and_stay_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "ITEMS_A_TASK", 100)
    monkeypatch.setattr(views, "LEAST_ITEMS", 100)
    found = []
    for n in (50, 3_000, 12_000):
        sf = _items(spark, tmp_path / str(n), n, 40)
        tasks, hot = views.station_tasks(spark, sf)
        assert hot.none
        rows = views.obs(spark, sf, ["us_aqi"], tasks=tasks)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # rows per station and day need no second one
        where = rows.select("station", F.spark_partition_id().alias("p")).distinct()
        assert where.groupBy("station").count().filter("count > 1").isEmpty()
        found.append(tasks)
    assert found == [1, 30, 120]


def test_a_hot_station_keeps_its_partial_sums(spark, tmp_path):
    sf = _items(spark, tmp_path, 500, 2)
    spark.conf.set("airloom.maxStationRows", "100")
    try:
        tasks, hot = views.station_tasks(spark, sf)
    finally:
        spark.conf.unset("airloom.maxStationRows")
    assert tasks is None and not hot.every


def test_copies_of_a_key_meet_in_the_tasks_they_are_in(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "ITEMS_A_TASK", 100)
    sf = _items(spark, tmp_path, 3_000, 40)
    kept = C.deduplicate(copies(spark, sf), "ingest_seq", keep="last")
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # one for each set of copies
    assert kept.rdd.getNumPartitions() == 30  # the table's tasks, not a fixed number
    assert kept.filter("ingest_seq = 1").count() == kept.count() == views.obs(spark, sf, ["us_aqi"]).count()
