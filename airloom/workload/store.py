"""Feature table, snapshots, splits, incremental refresh and the stream. Each query writes its own
tables under the shared folder and returns what is read back."""

from pyspark.sql import functions as F

from ..models import registry as R
from ..operators.recent import latest_time
from ..plans import training as T
from ..session import new_path
from ..sources import landing, store
from ..streaming import hourly, incremental
from .catalog import comparable, comparable_sql, register
from .features import holidays
from .sql import lag_sql, lead_sql, rolling_sql
from .views import HOURLY_EVENTS, HOURLY_SQL, obs, obs_sql, station_tasks, table

AIR = ["us_aqi", "pm2_5", "pm10"]
AIR_SQL = obs_sql(AIR)
KEYS = "station datetime"
BUCKETS = 1  # the test tables are small
CUT = "2001-06-01"
OVERLAP_FROM = "2001-03-20"  # the late batch goes back over the last 72 stored steps


def build(spark, df, name):
    path = new_path(spark, name)
    store.rebuild(df, path, BUCKETS)
    return path


@register("k1_k2_s8_table_rebuild", comparable_sql(AIR_SQL, KEYS, AIR))
def rebuilt(spark, sf_dir):
    return comparable(store.read_table(spark, build(spark, obs(spark, sf_dir, AIR), "rebuild")))


@register("k1_csv_replace", comparable_sql(AIR_SQL, KEYS, AIR))
def csv_replaced(spark, sf_dir):
    path = new_path(spark, "combined")
    store.write_csv(obs(spark, sf_dir, AIR).withColumn("us_aqi", F.lit(0.0)), path)
    store.write_csv(obs(spark, sf_dir, AIR), path)
    return comparable(landing.read_csv(spark, path, AIR))


LATE_SQL = f"SELECT station, datetime, us_aqi + 1 AS us_aqi, pm2_5, pm10 FROM ({AIR_SQL}) AS o WHERE datetime >= TIMESTAMP '{OVERLAP_FROM}'"
EARLY_SQL = f"SELECT station, datetime, us_aqi, pm2_5, pm10 FROM ({AIR_SQL}) AS o WHERE datetime < TIMESTAMP '{CUT}'"
MERGED_SQL = f"{LATE_SQL} UNION ALL SELECT * FROM ({EARLY_SQL}) AS e WHERE datetime < TIMESTAMP '{OVERLAP_FROM}'"


def since(day):
    return F.col("datetime") >= F.lit(day).cast("timestamp_ntz")


def early(spark, sf_dir):
    return obs(spark, sf_dir, AIR).filter(~since(CUT))


def late(spark, sf_dir):
    """A batch that overlaps the stored rows, with corrected values."""
    rows = obs(spark, sf_dir, AIR).filter(since(OVERLAP_FROM))
    return rows.withColumn("us_aqi", F.col("us_aqi") + 1)


@register("k3_upsert", comparable_sql(MERGED_SQL, KEYS, AIR))
def upserted(spark, sf_dir):
    path = build(spark, early(spark, sf_dir), "upsert")
    store.upsert(late(spark, sf_dir), path)
    return comparable(store.read_table(spark, path))


@register("k3_upsert_twice", comparable_sql(MERGED_SQL, KEYS, AIR))
def upserted_twice(spark, sf_dir):
    """A repeated batch changes nothing."""
    path = build(spark, early(spark, sf_dir), "upsert")
    for _ in range(2):
        store.upsert(late(spark, sf_dir), path)
    return comparable(store.read_table(spark, path))


@register("k3_compaction", comparable_sql(MERGED_SQL, KEYS, AIR))
def compacted(spark, sf_dir):
    """Batch by batch, then the months that batches share are merged."""
    path = build(spark, early(spark, sf_dir), "compact")
    for begin, end in ((OVERLAP_FROM, CUT), (CUT, "2030-01-01")):
        store.upsert(late(spark, sf_dir).filter(since(begin) & ~since(end)), path)
    store.compact(spark, path)
    return comparable(store.read_table(spark, path))


@register("s9_t2_stored_recent_rows", comparable_sql(
    f"SELECT * FROM (SELECT *, max(datetime) OVER (PARTITION BY station) AS latest FROM ({MERGED_SQL}) AS m) AS w "
    "WHERE datetime >= latest - INTERVAL 45 DAY", KEYS, AIR))
def stored_recent(spark, sf_dir):
    """From the partitions that the newest times name, batches included."""
    path = build(spark, early(spark, sf_dir), "recent")
    store.upsert(late(spark, sf_dir), path)
    return comparable(store.read_last(spark, path, "45 days"))


@register("a13_stored_latest_times", f"SELECT station, max(datetime) AS latest FROM ({MERGED_SQL}) AS m GROUP BY 1")
def stored_latest(spark, sf_dir):
    path = build(spark, early(spark, sf_dir), "latest")
    store.upsert(late(spark, sf_dir), path)
    return store.latest_times(spark, path)


MIRROR_AS_OF, MIRROR_YEARS = "2001-11-10", 4


@register("k4_i5_csv_mirror_with_retention", comparable_sql(
    f"SELECT * FROM ({MERGED_SQL}) AS m WHERE datetime >= TIMESTAMP '{MIRROR_AS_OF}' - INTERVAL {MIRROR_YEARS} YEAR", KEYS, AIR))
def mirrored(spark, sf_dir):
    path = new_path(spark, "mirror")
    store.update_mirror(early(spark, sf_dir), path, MIRROR_AS_OF, MIRROR_YEARS)
    return comparable(store.update_mirror(late(spark, sf_dir), path, MIRROR_AS_OF, MIRROR_YEARS))


@register("k5_retention_prune", comparable_sql(
    f"SELECT * FROM ({AIR_SQL}) AS o WHERE datetime >= TIMESTAMP '2001-11-10' - INTERVAL 4 YEAR", KEYS, AIR))
def pruned(spark, sf_dir):
    path = build(spark, obs(spark, sf_dir, AIR), "prune")
    store.prune(spark, path, "2001-11-10", 4)
    return comparable(store.read_table(spark, path))


def split_sql(body: str) -> str:
    return ("SELECT *, CASE WHEN datetime < last - INTERVAL 12 MONTH + INTERVAL 1 DAY THEN 'train' ELSE 'test' END AS split "
            f"FROM (SELECT *, max(datetime) OVER () AS last FROM ({body}) AS b) AS l")


@register("k6_f14_u4_train_test_split", comparable_sql(split_sql(AIR_SQL), "station datetime split", AIR))
def split_written(spark, sf_dir):
    path = new_path(spark, "split")
    T.add_split(obs(spark, sf_dir, AIR), "1 day").write.partitionBy("split").parquet(path)
    return comparable(spark.read.parquet(path))


@register("k7_s10_training_snapshot", comparable_sql(
    f"SELECT *, 2 AS td_version FROM ({split_sql(AIR_SQL)}) AS s", "station datetime split td_version", AIR))
def snapshot(spark, sf_dir):
    """Two refreshes make two versions; the latest is read."""
    path = new_path(spark, "snapshot")
    rows = T.add_split(obs(spark, sf_dir, AIR), "1 day")
    store.write_snapshot(rows.filter(F.col("us_aqi") > 0), path)
    store.write_snapshot(rows, path)
    version = store.latest_version(spark, path)
    return comparable(store.read_snapshot(spark, path).withColumn("td_version", F.lit(version)))


@register("k7_i6_snapshot_metadata",
          "SELECT CAST(v AS BIGINT) AS version, min(CASE WHEN split = 'train' THEN datetime END) AS train_start, "
          "max(CASE WHEN split = 'train' THEN datetime END) AS train_end, "
          "min(CASE WHEN split = 'test' THEN datetime END) AS test_start, "
          "max(CASE WHEN split = 'test' THEN datetime END) AS test_end, count(*) AS rows "
          f"FROM ({split_sql(AIR_SQL)}) AS s CROSS JOIN (VALUES (1), (2)) AS n(v) GROUP BY 1")
def metadata(spark, sf_dir):
    path = new_path(spark, "versions")
    rows = T.add_split(obs(spark, sf_dir, AIR), "1 day")
    for _ in range(2):
        store.write_snapshot(rows, path)
    return comparable(store.snapshot_metadata(spark, path))


@register("k8_write_verification",
          "SELECT count(*) AS rows, min(datetime) AS first_datetime, max(datetime) AS last_datetime, "
          f"CAST(0 AS BIGINT) AS duplicate_keys, true AS matches FROM ({AIR_SQL}) AS o")
def verification(spark, sf_dir):
    rows = obs(spark, sf_dir, AIR)
    path = build(spark, rows, "verify")
    return comparable(store.verify(store.read_table(spark, path), expected_rows=rows.count()))


@register("k10_schema_alignment",
          "SELECT l_orderkey, l_linenumber, CAST(TRY_CAST(l_partkey AS SMALLINT) AS DOUBLE) AS l_partkey, "
          "round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE), 6) + 0.0 AS l_quantity, "
          "CAST(CAST(trunc(l_extendedprice) AS INTEGER) AS BIGINT) AS l_extendedprice FROM "
          "(SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey * 100 AS l_partkey, l_quantity, "
          "l_extendedprice FROM lineitem) AS l")
def aligned(spark, sf_dir):
    stored = spark.createDataFrame(
        [], "l_orderkey bigint, l_linenumber smallint, l_partkey smallint, l_quantity float, l_extendedprice int")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 100).alias("l_partkey"), "l_quantity", "l_extendedprice")
    aligned_rows = store.align_to(rows, stored.schema)
    return comparable(aligned_rows.withColumn("l_partkey", F.col("l_partkey").cast("double")))


@register("k10_alignment_losses",
          "SELECT \"column\", CAST(lost_values AS BIGINT) AS lost_values FROM (SELECT 'l_partkey' AS \"column\", "
          "coalesce(sum(CASE WHEN TRY_CAST(l_partkey * 100 AS SMALLINT) IS NULL THEN 1 END), 0) AS lost_values FROM lineitem "
          "UNION ALL SELECT 'l_quantity', 0) AS l")
def losses(spark, sf_dir):
    stored = spark.createDataFrame([], "l_partkey smallint, l_quantity float")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 100).alias("l_partkey"), "l_quantity")
    return store.alignment_losses(rows, stored.schema)


def registry_rows(spark, sf_dir):
    """Suppliers as model names, their order lines' years as versions."""
    year = F.year("l_shipdate").cast("int")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.concat(F.lit("aqi_"), F.col("l_suppkey").cast("string"), F.lit("_24h")).alias("name"), year.alias("version"),
    ).agg(F.avg("l_quantity").alias("rmse"))


_REGISTRY_SQL = ("SELECT 'aqi_' || CAST(l_suppkey AS VARCHAR) || '_24h' AS name, CAST(year(l_shipdate) AS BIGINT) AS version, "
                 "avg(l_quantity) AS rmse FROM lineitem GROUP BY 1, 2")


@register("k13_registry_latest", comparable_sql(
    f"SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS rn FROM ({_REGISTRY_SQL}) AS r",
    "name version", "rmse") + " WHERE rn = 1")
def registry_latest(spark, sf_dir):
    return comparable(R.latest_models(registry_rows(spark, sf_dir)))


@register("k13_registry_versions", comparable_sql(
    f"SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS position FROM ({_REGISTRY_SQL}) AS r",
    "name version position", "rmse"))
def registry_versions(spark, sf_dir):
    return comparable(R.list_versions(registry_rows(spark, sf_dir)))


# --- incremental --------------------------------------------------------------------------------

_LATEST_SQL = f"SELECT station, max(datetime) AS latest FROM ({EARLY_SQL}) AS e GROUP BY 1"


@register("p5_i3_upsert_selection", comparable_sql(
    f"SELECT o.* FROM ({AIR_SQL}) AS o LEFT JOIN ({_LATEST_SQL}) AS l ON o.station = l.station "
    "WHERE latest IS NULL OR datetime > latest - INTERVAL 72 DAY", KEYS, AIR))
def selection(spark, sf_dir):
    latest = latest_time(early(spark, sf_dir))
    return comparable(incremental.rows_to_upsert(obs(spark, sf_dir, AIR), latest, "72 days"))


_SINCE_SQL = (
    "SELECT station, CASE WHEN count(*) > 72 THEN least(min(datetime), max(datetime) - INTERVAL 72 DAY) END AS since FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn FROM ({EARLY_SQL}) AS e) AS r WHERE rn <= 73 GROUP BY 1")


@register("i2_look_back_window", comparable_sql(
    "SELECT * FROM (SELECT o.*, since, sum(CASE WHEN datetime <= since THEN 1 ELSE 0 END) "
    "OVER (PARTITION BY o.station ORDER BY datetime DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS earlier "
    f"FROM ({AIR_SQL}) AS o LEFT JOIN ({_SINCE_SQL}) AS s ON o.station = s.station) AS w "
    "WHERE since IS NULL OR datetime > since OR earlier <= 168", KEYS, AIR))
def look_back(spark, sf_dir):
    start = incremental.repair_start(early(spark, sf_dir), repair="72 days")
    return comparable(incremental.look_back_window(obs(spark, sf_dir, AIR), start))


@register("i4_cold_start", comparable_sql(AIR_SQL, KEYS, AIR))
def cold_start(spark, sf_dir):
    """Nothing stored yet: every row is sent."""
    nothing = latest_time(obs(spark, sf_dir, AIR).filter(F.lit(False)))
    return comparable(incremental.rows_to_upsert(obs(spark, sf_dir, AIR), nothing))


VARIABLES = [
    "temperature_2m", "relative_humidity_2m", "precipitation", "pressure_msl", "wind_speed_10m", "wind_direction_10m",
    "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "us_aqi",
]


def dense(df):
    """Variables without missing readings, so that no repair depends on where a window begins."""
    return df.withColumns({"pm10": F.col("ozone") + 1, "pm2_5": F.col("nitrogen_dioxide") + 1})


def dense_rows(spark, sf_dir):
    return dense(obs(spark, sf_dir, VARIABLES, tasks=station_tasks(spark, sf_dir)[0]))


STORED = ["us_aqi", "aqi_lag_72h", "aqi_rolling_mean_168h", "pm10_rolling_mean_72h", "aqi_rolling_std_24h",
          "target_us_aqi_72h_ahead"]
_DENSE_SQL = f"SELECT *, ozone + 1 AS pm10, nitrogen_dioxide + 1 AS pm2_5 FROM ({obs_sql(VARIABLES)}) AS o"


def _stored_sql() -> str:
    body = (f"SELECT station, datetime, us_aqi, {lag_sql('us_aqi', 72, 'aqi_lag_72h')}, "
            f"{rolling_sql('avg', 'us_aqi', 168, 'aqi_rolling_mean_168h')}, {rolling_sql('avg', 'pm10', 72, 'pm10_rolling_mean_72h')}, "
            f"{rolling_sql('stddev_samp', 'us_aqi', 24, 'aqi_rolling_std_24h')}, {lead_sql('us_aqi', 72, 'target_us_aqi_72h_ahead')} "
            f"FROM ({_DENSE_SQL}) AS d")
    return comparable_sql(body, KEYS, STORED)


@register("i1_incremental_refresh", _stored_sql())
def refreshed(spark, sf_dir):
    """Backfill up to a cut, then one refresh: the table must equal a full rebuild."""
    raw = dense_rows(spark, sf_dir)
    path = new_path(spark, "incremental")
    incremental.backfill(raw.filter(~since(CUT)), path, holidays(spark, sf_dir), buckets=BUCKETS)
    incremental.refresh(raw, path, holidays(spark, sf_dir), repair="72 days")
    return comparable(store.read_table(spark, path).select("station", "datetime", *STORED))


@register("i1_late_rows", _stored_sql())
def refreshed_after_late_rows(spark, sf_dir):
    """Rows from long before the last stored one arrive late: the refresh must also make their features."""
    raw = dense_rows(spark, sf_dir)
    late = since("1998-03-01") & ~since("1998-06-01")
    path = new_path(spark, "late")
    incremental.backfill(raw.filter(~late), path, holidays(spark, sf_dir), buckets=BUCKETS)
    incremental.refresh(raw, path, holidays(spark, sf_dir), repair="72 days")
    return comparable(store.read_table(spark, path).select("station", "datetime", *STORED))


@register("i1_stream_refresh", _stored_sql())
def refreshed_by_stream(spark, sf_dir):
    """The same through payload landing files and a file stream, in two arrivals."""
    names = [*VARIABLES, "pm10", "pm2_5"]
    raw = dense_rows(spark, sf_dir)
    landed, raw_path, path, checkpoint = (new_path(spark, n) for n in ("landed", "raw", "features", "progress"))
    store.rebuild(raw.filter(~since(CUT)), raw_path, BUCKETS)
    incremental.backfill(raw.filter(~since(CUT)), path, holidays(spark, sf_dir), buckets=BUCKETS)
    for begin, end in ((CUT, "2001-08-15"), ("2001-08-01", "2002-01-01")):
        arrived = raw.filter(since(begin) & ~since(end))
        landing.to_payloads(arrived, names).write.mode("append").json(landed)
        stream = spark.readStream.schema(landing.payload_schema(names)).json(landed)
        incremental.run_refresh_stream(
            spark, landing.explode_payload(stream, names), raw_path, path, checkpoint, holidays(spark, sf_dir), "72 days")
    return comparable(store.read_table(spark, path).select("station", "datetime", *STORED))


@register("i7_hourly_tumbling_means", comparable_sql(HOURLY_SQL, KEYS, list(HOURLY_EVENTS)))
def tumbling(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("station", F.expr("user_id % 4"))
    return comparable(hourly.hourly_means(events, HOURLY_EVENTS))


@register("i7_hourly_tumbling_stream", comparable_sql(
    f"SELECT * FROM ({HOURLY_SQL}) AS h WHERE datetime + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 72 HOUR FROM events)",
    KEYS, list(HOURLY_EVENTS)))
def tumbling_stream(spark, sf_dir):
    """Event stream with a watermark; hours past it when the run ends."""
    source = table(spark, sf_dir, "events")
    out, checkpoint = new_path(spark, "hours"), new_path(spark, "progress")
    events = (spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
              .withColumn("station", F.expr("user_id % 4")))
    query = (hourly.hourly_means_stream(events, HOURLY_EVENTS).writeStream.outputMode("append").format("parquet")
             .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return comparable(spark.read.parquet(out))

