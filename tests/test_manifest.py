"""The feature table as a row of writes: any interleaving of batches equals a plain table of newest rows."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from airloom.operators import recent
from airloom.session import new_path
from airloom.sources import manifest, store

DAY = dt.timedelta(days=1)


def content(df):
    return sorted(map(tuple, df.select("station", "datetime", "us_aqi").collect()))


def rows_in(spark, path, number):
    return spark.read.parquet(f"{path}/data/write_no={number}").count()


@pytest.fixture
def scan_filters(spark):
    """Partition filters of all scans of a plan, in full."""
    def found(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line.split("PartitionFilters: [")[1].split("PushedFilters")[0] for line in plan.splitlines() if "PartitionFilters: [" in line]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield found
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_interleaving_equals_the_newest_rows(spark, seed):
    """Batches over random keys with repeats, compactions and a rebuild, against a dictionary."""
    rng, path, want = random.Random(seed), new_path(spark, "t"), {}
    start = dt.datetime(2024, 1, 25)

    def batch(n):
        rows = [(rng.randint(1, 4), start + rng.randint(0, 14) * DAY, rng.random(), i) for i in range(n)]
        rng.shuffle(rows)
        return rows, spark.createDataFrame(rows, "station long, datetime timestamp_ntz, us_aqi double, seq int")

    def take(rows):
        want.update({(s, t): v for s, t, v, i in sorted(rows, key=lambda r: r[3])})

    rows, df = batch(30)
    take(rows)
    store.rebuild(store.deduplicate(df, "seq", keep="last").drop("seq"), path, buckets=2)
    for step in range(6):
        rows, df = batch(rng.choice([0, 1, 8]))
        take(rows)
        for _ in range(rng.choice([1, 2])):
            store.upsert(df, path, seq="seq")
        if step % 3 == 2:
            store.compact(spark, path)
            assert all(len(writes) == 1 for writes in manifest.load(spark, path).writes_of().values())
    assert content(store.read_table(spark, path)) == sorted((*k, v) for k, v in want.items())
    newest = {s: max(t for k, t in want if k == s) for s, _ in want}
    assert dict(map(tuple, store.latest_times(spark, path).collect())) == newest


def test_a_batch_writes_only_its_rows(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0] * 24 * 80), path, buckets=1)
    store.upsert(series([2.0] * 3), path)
    state = manifest.load(spark, path)
    assert sorted(state.live) == [1, 2] and state.live[2] == {(0, 202401)} and rows_in(spark, path, 2) == 3
    assert store.read_table(spark, path).count() == 24 * 80
    store.compact(spark, path)  # January alone is written anew
    state = manifest.load(spark, path)
    assert state.live[3] == {(0, 202401)} and rows_in(spark, path, 3) == 24 * 31
    assert state.live[1] == {(0, 202402), (0, 202403)} and 2 not in state.live
    assert store.read_table(spark, path).filter("us_aqi = 2").count() == 3


def test_partitions_with_many_writes_are_merged(spark, series, monkeypatch):
    path = new_path(spark, "t")
    store.rebuild(series([1.0] * 24 * 40), path, buckets=1)
    monkeypatch.setattr(store._crowded, "__defaults__", (2, 100))
    for value in (2.0, 3.0):
        store.upsert(series([value]), path)
    writes = manifest.load(spark, path).writes_of()
    assert len(writes[(0, 202401)]) == 1 and writes[(0, 202402)] == [1]
    assert content(store.read_table(spark, path))[0][2] == 3.0
    monkeypatch.setattr(store._crowded, "__defaults__", (100, 2))  # few open writes in all
    for month in (2, 3):
        store.upsert(series([4.0], start=dt.datetime(2024, month, 1)), path)
    assert len(manifest.load(spark, path).live) <= 2
    assert store.read_table(spark, path).filter("us_aqi = 4").count() == 2


def test_writes_that_were_cut_off_do_not_count(spark, series):
    """Rows without a manifest, as after a lost driver, are not read, and their number is not used again."""
    path = new_path(spark, "t")
    store.rebuild(series([1.0, 2.0]), path, buckets=2)
    left = store._with_partitions(series([9.0, 9.0, 9.0]), 2)
    assert store._write_rows(left, path) == 2
    assert store.read_table(spark, path).count() == 2
    store.upsert(series([3.0]), path)
    assert sorted(manifest.load(spark, path).live) == [1, 3]
    assert [v for *_, v in content(store.read_table(spark, path))] == [3.0, 2.0]
    store.rebuild(series([5.0]), path, buckets=2)
    store.rebuild(series([6.0]), path, buckets=2)  # the manifest before it stays for readers
    fs, at = manifest.file_system(spark, f"{path}/data/write_no=*")
    assert [f.getPath().getName() for f in fs.globStatus(at)] == ["write_no=4", "write_no=5"]
    assert not store.table_exists(spark, new_path(spark, "nothing"))


def test_a_reader_keeps_its_state(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0, 2.0]), path, buckets=1)
    begun = store.read_table(spark, path)
    store.rebuild(series([7.0]), path, buckets=1)
    assert begun.count() == 2 and store.read_table(spark, path).count() == 1


def test_a_second_writer_is_refused(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0]), path, buckets=1)
    before, state = manifest.newest(spark, path), manifest.load(spark, path)
    store.upsert(series([2.0]), path)
    with pytest.raises(RuntimeError, match="another writer"):
        manifest.commit(spark, path, state, before)
    assert content(store.read_table(spark, path))[0][2] == 2.0


def test_other_columns_are_refused(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0]).withColumn("pm10", F.lit(1.0)), path, buckets=1)
    for bad in (series([2.0]), series([2.0]).withColumns({"pm10": F.lit(1.0), "new": F.lit(1)})):
        with pytest.raises(ValueError, match="nothing is written"):
            store.upsert(bad, path)


def test_filters_reach_shared_partitions(spark, series, scan_filters):
    """Both scans, of merged and of other partitions, are cut by month."""
    path = new_path(spark, "t")
    store.rebuild(series([1.0] * 24 * 80), path, buckets=1)
    store.upsert(series([2.0], start=dt.datetime(2024, 3, 1)), path)
    got = store.read_table(spark, path, since=dt.datetime(2024, 3, 1))
    filters = scan_filters(got)
    assert len(filters) == 2 and ">= 202403)" in filters[0] and "= 202403)" in filters[1]
    assert got.count() == 24 * 20 and got.filter("us_aqi = 2").count() == 1


def test_newest_rows_come_from_the_named_months(spark, series, scan_filters):
    """A station that fell silent long ago, one that goes on, and a late batch."""
    path = new_path(spark, "t")
    old = series([3.0] * 10, station=2, start=dt.datetime(2019, 5, 31, 20))
    store.rebuild(series([float(i) for i in range(24 * 80)]).unionByName(old), path, buckets=4)
    store.upsert(series([50.0], station=3, start=dt.datetime(2021, 2, 1)).unionByName(series([60.0])), path)
    whole = store.read_table(spark, path)
    assert content(store.read_last(spark, path)) == content(recent.latest_row(whole))
    assert content(store.read_last(spark, path, "45 days")) == content(recent.recent(whole, "45 days"))
    filters = " ".join(scan_filters(store.read_last(spark, path)))
    assert "202403" in filters and "201906" in filters and "202102" in filters and "202402" not in filters
    store.prune(spark, path, "2024-06-01", years=4)
    assert sorted(r.station for r in store.latest_times(spark, path).collect()) == [1, 3]


def test_snapshots_are_committed_by_their_bounds(spark, series):
    path = new_path(spark, "s")
    rows = series([1.0] * 4).withColumn("split", F.when(F.hour("datetime") < 3, "train").otherwise("test"))
    assert store.snapshot_metadata(spark, path).count() == 0
    assert store.write_snapshot(rows, path) == 1
    rows.write.partitionBy("split").parquet(f"{path}/td_version=2")  # cut off before its bounds
    assert store.latest_version(spark, path) == 1 and store.write_snapshot(rows, path) == 3
    noted = {r.version: r for r in store.snapshot_metadata(spark, path).collect()}
    assert sorted(noted) == [1, 3] and noted[3].rows == 4
    assert (noted[3].train_start, noted[3].train_end, noted[3].test_start) == tuple(
        dt.datetime(2024, 1, 1, h) for h in (0, 2, 3))


def test_manifest_survives_json(spark, series):
    state = manifest.Manifest(4, series([1.0]).schema).add(1, frozenset({(0, 202401), (3, 202402)})).add(2, frozenset({(0, 202401)}))
    for one in (state, state.without({(0, 202401)})):
        assert manifest.Manifest.from_json(one.to_json()) == one
    assert sorted(json.loads(state.without({(0, 202401)}).to_json())["wrote"]) == ["1"]
