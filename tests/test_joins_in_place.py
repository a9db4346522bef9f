"""Points meet the observations of their station in the tasks where both lie already."""

import datetime as dt

from pyspark.sql import functions as F

from airloom.operators.joins import attach_points, widen_points

DAY = dt.datetime(2024, 1, 1)
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def test_points_are_attached_without_another_exchange(spark):
    day = F.lit(DAY).cast("timestamp_ntz") + F.col("d") * F.expr("INTERVAL 1 DAY")
    seen = spark.createDataFrame([(s, d, 1.0 * s + d) for s in (1, 2) for d in (0, 1)], "station long, d int, us_aqi double")
    seen = seen.select("station", day.alias("datetime"), "us_aqi").repartition(5, "station")
    long = spark.createDataFrame([(s, d, b, 10.0 * s + d, 2.0) for s in (1, 3) for d in (0, 2) for b in "NE"],
                                 "station long, d int, bearing string, pm2_5 double, us_aqi double")
    long = long.select("station", day.alias("datetime"), "bearing", "pm2_5", "us_aqi").repartition(5, "station")
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        joined = attach_points(seen, widen_points(long))
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # one for each side
        rows = {(r.station, r.datetime): (r.us_aqi, r.pm2_5_dir_N, r.pm2_5_dir_S) for r in joined.collect()}
    finally:
        spark.conf.set(THRESHOLD, before)
    assert len(rows) == 4
    assert rows[1, DAY] == (1.0, 10.0, None)
    assert rows[2, DAY] == (2.0, None, None)
