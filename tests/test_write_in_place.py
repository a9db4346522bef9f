"""Feature rows are written where they lie, and raw rows are worked out once for a refresh's window."""

import datetime as dt

from pyspark.sql import functions as F

from airloom.sources import store
from airloom.streaming import incremental

DAY = dt.datetime(2024, 1, 1)


def _rows(spark, days, value, stations=(1, 2, 3)):
    made = spark.createDataFrame([(s, d) for s in stations for d in days], "station long, d int")
    return made.select("station", (F.lit(DAY).cast("timestamp_ntz") + F.col("d") * F.expr("INTERVAL 1 DAY")).alias("datetime"),
                       (F.col("station") * 1000 + F.col("d") + value).cast("double").alias("us_aqi"))


def test_a_refresh_writes_rows_where_they_lie(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    plan = lambda raw, holidays, seq: raw.repartition(6, "station")
    store.rebuild(plan(_rows(spark, range(0, 60), 0.0), None, None), path, 1, tasks=2)
    assert 1 <= len(list(tmp_path.glob("t/data/write_no=*/station_bucket=0/month=202401/*.parquet"))) <= 2
    seen, real = [], store._write_rows
    monkeypatch.setattr(store, "_write_rows", lambda df, path, tasks=None: seen.append(tasks) or real(df, path, tasks))
    raw = _rows(spark, range(0, 90), 0.5)
    incremental.refresh(raw, path, None, repair="10 days", plan=plan)
    assert seen == [1]  # 270 rows at most: one task, and none of its rows is dealt out again
    got = {(r.station, r.datetime): r.us_aqi for r in store.read_table(spark, path).collect()}
    assert len(got) == 270
    assert got[2, DAY + dt.timedelta(days=89)] == 2089.5


def test_tasks_that_write_grow_with_the_rows(spark):
    assert store.write_tasks(spark, 0) == store.write_tasks(spark, 10) == 1
    assert store.write_tasks(spark, 100 * store.WRITE_ROWS + 1) == 101


def test_the_window_reads_raw_rows_once(spark):
    raw = _rows(spark, range(0, 300), 0.0)
    since = F.when(F.col("station") < 3, F.lit(DAY + dt.timedelta(days=200)).cast("timestamp_ntz"))
    start = raw.select("station").distinct().withColumn("since", since)
    window = incremental.look_back_window(raw.withColumn("mark", F.rand(1) < 2), start)
    assert "Union" not in window._jdf.queryExecution().analyzed().toString()
    days = {s: sorted(r.datetime for r in window.collect() if r.station == s) for s in (1, 2, 3)}
    assert len(days[3]) == 300  # nothing is stored of this station
    assert days[1] == days[2] == [DAY + dt.timedelta(days=d) for d in range(200 - 167, 300)]
