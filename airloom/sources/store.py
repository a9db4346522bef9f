"""Feature table, training snapshots and small result tables, as Parquet.

The feature table is keyed by (station, datetime) and partitioned by (station_bucket, month): a
time filter prunes months. An upsert writes only its own rows; reads put the newest row of a key first, and
partitions in which many writes have gathered are merged (:mod:`manifest`). One writer at a time.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import deduplicate
from ..schema import KEY, RETENTION_YEARS
from ..session import new_path
from . import manifest
from .manifest import PARTITIONS, WRITE

BUCKETS = 64
MAX_LISTED_PARTITIONS = 10_000
MAX_WRITES = 24  # of one partition before they are merged: a day of hourly batches
MAX_OPEN_WRITES = 256  # of the whole table
WRITE_ROWS = 400_000  # of one task that writes rows where they lie: some 250 MB of feature rows to sort
LEAST_WRITE_ROWS = 20_000  # that are worth a task of their own


# --- column names and types -------------------------------------------------------------------

def plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def _with_partitions(df: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("station"), F.lit(buckets)).cast("int")
    return df.withColumns({
        "station_bucket": bucket, "month": F.year("datetime") * 100 + F.month("datetime")})


def align_to(df: DataFrame, stored: T.StructType) -> DataFrame:
    """Cast columns to their stored types. A value that does not fit becomes null
    (:func:`alignment_losses` counts those); columns the store does not know stay as they are."""
    types = {f.name: f.dataType for f in stored}
    return df.select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def alignment_losses(df: DataFrame, stored: T.StructType) -> DataFrame:
    """Per column: values that turn null in :func:`align_to`."""
    types = {f.name: f.dataType for f in stored if f.name in df.columns}
    lost = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()]
    return df.agg(*lost).unpivot([], list(types), "column", "lost_values")


# --- the feature table: writes and their manifest ----------------------------------------------

def table_exists(spark: SparkSession, path: str) -> bool:
    return manifest.exists(spark, path)


def write_tasks(spark: SparkSession, rows: int) -> int:
    """In how many tasks so many rows are written where they lie: each makes a file for every partition that it has rows of."""
    return max(1, min(spark.sparkContext.defaultParallelism, rows // LEAST_WRITE_ROWS), -(-rows // WRITE_ROWS))


def _write_rows(df: DataFrame, path: str, tasks: int | None = None) -> int:
    """Rows with their partition columns as a new write, which counts only once a manifest names it.
    ``rebalance`` groups rows by partition, and splits the groups that are too large for a task. With ``tasks`` wide rows are not
    dealt out again: so many tasks at most write them where they lie."""
    number = manifest.next_write(df.sparkSession, path)
    grouped = df.coalesce(tasks) if tasks else df.hint("rebalance", *[F.col(p) for p in PARTITIONS])
    arranged = grouped.sortWithinPartitions(*PARTITIONS, *KEY)
    arranged.write.partitionBy(*PARTITIONS).parquet(f"{path}/data/{WRITE}={number}")
    return number


def _read_writes(spark: SparkSession, path: str, schema: T.StructType, writes: list[int]) -> DataFrame:
    """Rows of these writes, each with the number of its write."""
    numbered = T.StructType([*schema.fields, T.StructField(WRITE, T.LongType())])
    if not writes:
        return spark.createDataFrame([], numbered)
    return (spark.read.schema(numbered).option("basePath", f"{path}/data")
            .parquet(*[f"{path}/data/{WRITE}={n}" for n in writes]))


def _stored(spark: SparkSession, path: str, state: manifest.Manifest | None = None) -> DataFrame:
    """The rows that count, with their partition columns. Only partitions that several writes share are
    merged, with an exchange; the others are read as they are."""
    state = state or manifest.load(spark, path)
    rows = _read_writes(spark, path, state.schema, sorted(state.live))
    if (counting := state.counting()) is not None:
        rows = rows.filter(counting)
    shared = {p for p, writes in state.writes_of().items() if len(writes) > 1}
    if not shared:
        return rows.drop(WRITE)
    here = manifest.partition_filter(shared)
    # the partition columns belong to the window's keys, so that filters on them pass through to the scan
    newest = Window.partitionBy(*PARTITIONS, *KEY).orderBy(F.desc(WRITE))
    merged = rows.filter(here).withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth", WRITE)
    return rows.filter(~here).drop(WRITE).unionByName(merged)


def read_table(spark: SparkSession, path: str, since=None, before=None) -> DataFrame:
    """The table, or its rows from ``since`` / up to ``before`` (datetimes): the months outside are
    not read."""
    df = _stored(spark, path)
    if since is not None:
        df = df.filter((F.col("month") >= since.year * 100 + since.month)
                       & (F.col("datetime") >= F.lit(since).cast("timestamp_ntz")))
    if before is not None:
        df = df.filter((F.col("month") <= before.year * 100 + before.month)
                       & (F.col("datetime") < F.lit(before).cast("timestamp_ntz")))
    return df.drop(*PARTITIONS)


def read_state(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """All rows, and the number of the change that made them: equal numbers mean equal rows."""
    state = manifest.load(spark, path)
    return _stored(spark, path, state).drop(*PARTITIONS), state.changed


# --- newest times per station --------------------------------------------------------------------

def _note_latest(rows: DataFrame, path: str, number: int) -> None:
    """Newest time per station of a write, beside it: one small row per station."""
    rows.groupBy("station").agg(F.max("datetime").alias("latest")).write.parquet(f"{path}/_latest/{WRITE}={number}")


def _latest(spark: SparkSession, path: str, state: manifest.Manifest) -> DataFrame:
    types = {f.name: f.dataType for f in state.schema}
    schema = T.StructType([T.StructField("station", types["station"]), T.StructField("latest", types["datetime"])])
    if not state.latest:
        return spark.createDataFrame([], schema)
    noted = spark.read.schema(schema).parquet(*[f"{path}/_latest/{WRITE}={n}" for n in state.latest])
    return noted.groupBy("station").agg(F.max("latest").alias("latest"))


def latest_times(spark: SparkSession, path: str) -> DataFrame:
    """(station, latest) of every stored station, without a look at the table's rows."""
    return _latest(spark, path, manifest.load(spark, path))


def read_last(spark: SparkSession, path: str, lookback: str = "0 days") -> DataFrame:
    """Rows of every station from its own newest time back by ``lookback`` (for example ``"45 days"``); the
    newest row alone by default. Only the partitions that hold such rows are read."""
    state = manifest.load(spark, path)
    since = _latest(spark, path, state).withColumn("_since", F.col("latest") - F.expr(f"INTERVAL {lookback}"))
    months = F.sequence(F.trunc("_since", "month"), F.trunc("latest", "month"), F.expr("INTERVAL 1 MONTH"))
    firsts = since.select("station", F.explode(months).alias("datetime"))
    named = _with_partitions(firsts, state.buckets)
    listed = named.select(*PARTITIONS).distinct().limit(MAX_LISTED_PARTITIONS + 1).collect()
    rows = _stored(spark, path)
    if len(listed) <= MAX_LISTED_PARTITIONS:
        rows = rows.filter(manifest.partition_filter({(r.station_bucket, r.month) for r in listed}))
    return (rows.join(since.select("station", "_since"), "station")
            .filter(F.col("datetime") >= F.col("_since")).drop("_since", *PARTITIONS).select(*_plain(state)))


def _plain(state: manifest.Manifest) -> list[str]:
    return [f.name for f in state.schema if f.name not in PARTITIONS]


def read_recent(
    spark: SparkSession, path: str, stations: DataFrame, rows: int, floor, upto: DataFrame | None = None,
) -> DataFrame:
    """Rows of the given stations from ``floor`` on; the whole history only of stations that have
    fewer than ``rows`` rows there (up to the station's ``since`` in ``upto``, if given)."""
    near = read_table(spark, path, since=floor).join(stations, "station", "left_semi")
    counted = near if upto is None else near.join(upto, "station").filter(F.col("datetime") <= F.col("since"))
    enough = counted.groupBy("station").agg(F.count("*").alias("n")).filter(F.col("n") >= rows)
    short = stations.join(enough, "station", "left_anti")
    if short.isEmpty():
        return near
    return near.unionByName(read_table(spark, path, before=floor).join(short, "station", "left_semi"))


def rebuild(df: DataFrame, path: str, buckets: int = BUCKETS, tasks: int | None = None) -> DataFrame:
    """Replace the whole feature table; its version stays the same. Returns the verification row. ``tasks``
    (:func:`write_tasks`): rows are written where they lie.

    The rows are written beside the old ones and checked there: keys must not be null or repeated. Only rows
    that pass are committed, in one step; until then, and for readers that have begun, the old table stands."""
    spark = df.sparkSession
    before = manifest.newest(spark, path)
    rows = _with_partitions(plain_names(df), buckets)
    number = _write_rows(rows, path, tasks)
    written = _read_writes(spark, path, rows.schema, [number]).drop(WRITE, *PARTITIONS)
    report = verify(written).collect()[0]
    lost = written.filter(F.col("station").isNull() | F.col("datetime").isNull()).count()
    if report.duplicate_keys or lost:
        fs, folder = manifest.file_system(spark, f"{path}/data/{WRITE}={number}")
        fs.delete(folder, True)
        raise ValueError(
            f"{report.duplicate_keys} rows share their (station, datetime) with another row, {lost} have none; the old table stays")
    _note_latest(written, path, number)
    state = manifest.Manifest(buckets, rows.schema, changed=before + 1)
    state = state.add(number, manifest.written_partitions(spark, path, number))
    manifest.commit(spark, path, state, before)
    manifest.vacuum(spark, path)
    return spark.createDataFrame([report], verify(written).schema)


def verify(stored: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Rows, time range and repeated keys of a stored table, read back once."""
    per_key = stored.groupBy(*KEY).agg(F.count("*").alias("n"))
    report = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min("datetime").alias("first_datetime"), F.max("datetime").alias("last_datetime"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"))
    if expected_rows is None:
        return report
    return report.withColumn("matches", F.col("rows") == F.lit(expected_rows))


def _refuse_losses(batch: DataFrame, stored: T.StructType) -> None:
    """Raise if a value would turn null on its way into the store, or a key is null already."""
    lost = {r["column"]: r["lost_values"] for r in alignment_losses(batch, stored).collect() if r["lost_values"]}
    missing = batch.filter(F.col("station").isNull() | F.col("datetime").isNull()).count()
    if lost or missing:
        raise ValueError(f"values that do not fit their columns: {lost}; rows without a key: {missing}; nothing is written")


def latest_wins(stored: DataFrame, batch: DataFrame, seq: str | None = None) -> DataFrame:
    """Union where a batch row replaces the stored row of the same key; within a batch the highest
    ``seq`` wins."""
    order = F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")
    marked = batch.withColumn("_at", order)
    if seq and seq not in stored.columns:
        marked = marked.drop(seq)
    newest = stored.withColumn("_at", F.lit(None).cast("bigint")).unionByName(marked)
    newest = newest.withColumn("_at", F.coalesce(F.col("_at"), F.lit(-(2**62))))
    return deduplicate(newest, "_at", keep="last").drop("_at")


def upsert(batch: DataFrame, path: str, seq: str | None = None, tasks: int | None = None) -> None:
    """Insert or replace rows by key. Only the batch is written, as a new write whose rows stand before older
    ones of their keys; partitions in which many writes have gathered are then compacted. Writing the
    same batch again changes no row, so a repeated run is safe. A batch with a null key, with a value that
    does not fit its stored column or with other columns is refused whole, before anything counts.

    A batch of the table's own types loses no value, so it is written once, as the write it becomes, and its keys are checked
    there; others are staged first. ``tasks`` as in :func:`rebuild`."""
    spark = batch.sparkSession
    before = manifest.newest(spark, path)
    state = manifest.load(spark, path)
    names, batch = _plain(state), plain_names(batch)
    types = {f.name: f.dataType for f in state.schema}
    if seq is None and sorted(batch.columns) == sorted(names) and all(types[f.name] == f.dataType for f in batch.schema):
        number = _write_unique(batch, path, state, tasks)
    else:
        staged = new_path(spark, "batch")  # the batch is computed once and read several times
        batch.write.parquet(staged)
        batch = spark.read.schema(batch.schema).parquet(staged)
        _refuse_losses(batch, state.schema)
        if other := (set(batch.columns) ^ set(names)) - {seq}:
            raise ValueError(f"columns that only the table or only the batch has: {sorted(other)}; nothing is written")
        rows = deduplicate(align_to(batch, state.schema), seq, keep="last").select(*names)
        number = _write_rows(_with_partitions(rows, state.buckets).select(*state.schema.names), path)
    partitions = manifest.written_partitions(spark, path, number)
    if not partitions:  # no rows
        return
    _note_latest(_read_writes(spark, path, state.schema, [number]), path, number)
    state = replace(state.add(number, partitions), changed=before + 1)
    manifest.commit(spark, path, state, before)
    if full := _crowded(state):
        compact(spark, path, full)


def _write_unique(batch: DataFrame, path: str, state: manifest.Manifest, tasks: int | None) -> int:
    """Write a batch and look at its keys there, without its other columns; only where keys repeat are the rows written again."""
    spark = batch.sparkSession
    number = _write_rows(_with_partitions(batch, state.buckets).select(*state.schema.names), path, tasks)
    written = _read_writes(spark, path, state.schema, [number]).select(*batch.columns)
    keyless = F.col("station").isNull() | F.col("datetime").isNull()
    missing = written.filter(keyless).count()
    repeated = 0 if missing else verify(written).first().duplicate_keys
    if not missing and not repeated:
        return number
    first, folder = manifest.file_system(spark, f"{path}/data/{WRITE}={number}")
    if missing:
        first.delete(folder, True)
        raise ValueError(f"values that do not fit their columns: {{}}; rows without a key: {missing}; nothing is written")
    rows = deduplicate(written, keep="last")
    number = _write_rows(_with_partitions(rows, state.buckets).select(*state.schema.names), path)
    first.delete(folder, True)
    return number


def _crowded(state: manifest.Manifest, per_partition: int = MAX_WRITES, writes: int = MAX_OPEN_WRITES) -> set:
    """Partitions in which more writes than ``per_partition`` have gathered; if more than ``writes`` are open in
    all, every partition of any but the largest write too."""
    full = {p for p, numbers in state.writes_of().items() if len(numbers) > per_partition}
    if len(state.live) > writes:
        largest = max(state.live, key=lambda n: len(state.live[n]))
        full |= {p for n, partitions in state.live.items() if n != largest for p in partitions}
    return full


def compact(spark: SparkSession, path: str, partitions: set | None = None) -> None:
    """Merge the writes of these partitions (all shared ones by default) into one; no row changes and no other
    partition is read."""
    before = manifest.newest(spark, path)
    state = manifest.load(spark, path)
    if partitions is None:
        partitions = {p for p, numbers in state.writes_of().items() if len(numbers) > 1}
    if not partitions:
        return
    _replace(spark, path, state, before, partitions, _stored(spark, path).filter(manifest.partition_filter(partitions)),
             _latest(spark, path, state))


def _replace(
    spark: SparkSession, path: str, state: manifest.Manifest, before: int, partitions: set, rows: DataFrame, latest: DataFrame,
) -> None:
    """Commit ``rows`` in place of all rows of ``partitions``, and ``latest`` in place of all newest times."""
    number = _write_rows(rows.select(*state.schema.names), path)
    _note_latest(latest.withColumnRenamed("latest", "datetime"), path, number)
    state = state.without(partitions)
    if written := manifest.written_partitions(spark, path, number):
        state = state.add(number, written)
    manifest.commit(spark, path, replace(state, latest=(number,)), before)
    manifest.vacuum(spark, path)


def retain(df: DataFrame, as_of, years: int = RETENTION_YEARS) -> DataFrame:
    """Rows of the last ``years`` before ``as_of``."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {years} YEAR")
    return df.filter(F.col("datetime") >= cutoff)


def prune(spark: SparkSession, path: str, as_of, years: int = RETENTION_YEARS) -> None:
    """Drop rows past retention: older months are dropped whole, the boundary month is rewritten. Off unless
    called."""
    before = manifest.newest(spark, path)
    state = manifest.load(spark, path)
    cutoff = spark.range(1).select(
        (F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {years} YEAR")).alias("t")).first().t
    boundary = cutoff.year * 100 + cutoff.month
    past = {p for p in state.writes_of() if p[1] <= boundary}
    if not past:
        return
    kept = F.col("datetime") >= F.lit(cutoff).cast("timestamp_ntz")
    rows = _stored(spark, path).filter(F.col("month") == boundary).filter(kept)
    latest = _latest(spark, path, state).filter(F.col("latest") >= F.lit(cutoff).cast("timestamp_ntz"))
    _replace(spark, path, replace(state, changed=before + 1), before, past, rows, latest)


# --- versioned snapshots and mirrors -----------------------------------------------------------

def _versions(spark: SparkSession, path: str, name: str) -> list[int]:
    """Version folders that were completely written."""
    fs, pattern = manifest.file_system(spark, f"{path}/{name}=*/_SUCCESS")
    done = fs.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName().split("=", 1)[1]) for f in done)


def latest_version(spark: SparkSession, path: str, name: str = "td_version") -> int:
    """The newest complete version; 1 where nothing is written yet."""
    return max(_versions(spark, f"{path}/_bounds" if name == "td_version" else path, name), default=1)


BOUNDS = ("version bigint, train_start timestamp_ntz, train_end timestamp_ntz, test_start timestamp_ntz, "
          "test_end timestamp_ntz, rows bigint, source bigint")


def write_snapshot(df: DataFrame, path: str, source: int | None = None) -> int:
    """Write a split table as the next training-data version and return its number. Earlier
    versions never change. A row of bounds, written last, is the commit: a version without it was cut off,
    is not read, and its number is not used again. ``source``: the change of the feature table it was made from."""
    spark = df.sparkSession
    version = max(_versions(spark, f"{path}/_bounds", "td_version") + _folders(spark, path, "td_version"), default=0) + 1
    arranged = df.hint("rebalance", F.col("split")).sortWithinPartitions("split", *KEY)
    target = f"{path}/td_version={version}"
    arranged.write.partitionBy("split").parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    _bounds(written, version, source).coalesce(1).write.parquet(f"{path}/_bounds/td_version={version}")
    return version


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Version folders, cut-off ones included."""
    fs, pattern = manifest.file_system(spark, f"{path}/{name}=*")
    return [int(f.getPath().getName().split("=", 1)[1]) for f in fs.globStatus(pattern) or []]


def _bounds(rows: DataFrame, version: int, source: int | None) -> DataFrame:
    def of(split: str):
        here = F.col("split") == split
        return [F.min(F.when(here, F.col("datetime"))).alias(f"{split}_start"),
                F.max(F.when(here, F.col("datetime"))).alias(f"{split}_end")]
    return rows.agg(*of("train"), *of("test"), F.count("*").alias("rows")).select(
        F.lit(version).cast("bigint").alias("version"), "*", F.lit(source).cast("bigint").alias("source"))


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/td_version={version or latest_version(spark, path)}")


def snapshot_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row per version: time range and rows of each split, as noted when it was written."""
    return noted_bounds(spark, path).drop("source")


def noted_bounds(spark: SparkSession, path: str) -> DataFrame:
    """The metadata with the change of the feature table that each version was made from."""
    versions = _versions(spark, f"{path}/_bounds", "td_version")
    if not versions:
        return spark.createDataFrame([], BOUNDS)
    return spark.read.schema(BOUNDS).parquet(*[f"{path}/_bounds/td_version={v}" for v in versions])


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table with a header, its columns found by name and cast; their order in the file does not
    matter. A missing column or a value that does not fit raises."""
    texts = spark.read.option("header", True).csv(path)
    return texts.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def update_mirror(batch: DataFrame, path: str, as_of, years: int = RETENTION_YEARS) -> DataFrame:
    """CSV mirror of the feature table: append, keep the last row of a key, then trim to the
    retention period. Each update is a new generation, so a failed write leaves the old one whole."""
    spark = batch.sparkSession
    generations = _versions(spark, path, "generation")
    combined = batch
    if generations:
        combined = latest_wins(read_csv_by_name(spark, f"{path}/generation={generations[-1]}", batch.schema), batch)
    target = f"{path}/generation={max(generations, default=0) + 1}"
    write_csv(retain(combined, as_of, years), target)
    return read_csv_by_name(spark, target, batch.schema)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV table, replaced if present, in time order inside each file."""
    df.sortWithinPartitions(*KEY).write.mode("overwrite").option("header", True).csv(path)


def write_results(df: DataFrame, path: str) -> None:
    """A small result table."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
