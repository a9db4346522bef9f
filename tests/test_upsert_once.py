"""An upsert of the table's own types is written once."""

from pyspark.sql import functions as F

from airloom.sources import store


def test_a_batch_of_the_tables_types_is_written_once(spark, tmp_path, monkeypatch):
    rows = lambda values: spark.createDataFrame(values, "station long, d int, v double").select(
        "station", (F.lit("2020-01-01").cast("timestamp_ntz") + F.col("d") * F.expr("INTERVAL 1 DAY")).alias("datetime"), "v")
    path = str(tmp_path / "t")
    store.rebuild(rows([(1, 0, 1.0), (2, 0, 2.0)]), path, 1)
    staged = []
    monkeypatch.setattr(store, "new_path", lambda *_: staged.append(1) or str(tmp_path / "staged"))
    store.upsert(rows([(1, 0, 5.0), (1, 40, 6.0)]), path)
    assert not staged
    store.upsert(rows([(2, 0, 7.0), (2, 0, 7.0)]), path)  # a repeated key
    found = sorted((r.station, r.v) for r in store.read_table(spark, path).collect())
    assert found == [(1, 5.0), (1, 6.0), (2, 7.0)]
    try:
        store.upsert(rows([(None, 0, 8.0), (1, 0, 9.0)]), path)
        raise AssertionError("a row without a key was taken")
    except ValueError as e:
        assert "rows without a key: 1" in str(e)
    assert sorted((r.station, r.v) for r in store.read_table(spark, path).collect()) == found
