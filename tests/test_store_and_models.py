"""Table maintenance, refresh, models and explanations."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.models import explain, registry, ridge, trees
from airloom.operators.metrics import regression_metrics
from airloom.plans import train as E
from airloom.plans.forecast import forecast
from airloom.plans.training import add_split, cv_blocks
from airloom.schema import TARGETS
from airloom.session import new_path
from airloom.sources import landing, store
from airloom.streaming import incremental


def rows_of(df):
    return sorted(map(tuple, df.select("station", "datetime", "us_aqi").collect()))


def test_upsert_replaces_inserts_and_repeats(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0, 2.0, 3.0]).unionByName(series([9.0], station=2)), path, buckets=4)
    batch = series([20.0, 30.0, 40.0], start=dt.datetime(2024, 1, 1, 1))
    for _ in range(2):
        store.upsert(batch, path)
        got = rows_of(store.read_table(spark, path))
        assert [r[2] for r in got] == [1.0, 20.0, 30.0, 40.0, 9.0]


def test_upsert_takes_the_last_row_of_a_batch(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0]), path, buckets=1)
    batch = series([5.0]).withColumn("seq", F.lit(2)).unionByName(series([4.0]).withColumn("seq", F.lit(1)))
    store.upsert(batch, path, seq="seq")
    assert [r[2] for r in rows_of(store.read_table(spark, path))] == [5.0]


def test_rebuild_rejects_repeated_keys(spark, series):
    with pytest.raises(ValueError, match="share"):
        store.rebuild(series([1.0]).unionByName(series([2.0])), new_path(spark, "t"), buckets=1)


def test_filter_prunes_partitions(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0] * 24 * 80), path, buckets=1)
    plan = spark.read.parquet(path).filter(F.col("month") == 202402)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_prune_and_retain(spark, series):
    path = new_path(spark, "t")
    old = series([1.0] * 3, start=dt.datetime(2019, 5, 1))
    edge = series([2.0] * 48, start=dt.datetime(2020, 2, 1))
    store.rebuild(old.unionByName(edge).unionByName(series([3.0])), path, buckets=2)
    store.prune(spark, path, "2024-02-02", years=4)
    got = rows_of(store.read_table(spark, path))
    assert len(got) == 25 and got[0][1] == dt.datetime(2020, 2, 2)


def test_snapshots_count_up(spark, series):
    path = new_path(spark, "t")
    assert store.latest_version(spark, path) == 1
    rows = add_split(series([1.0] * 10))
    assert [store.write_snapshot(rows, path) for _ in range(3)] == [1, 2, 3]
    assert store.latest_version(spark, path) == 3 and store.read_snapshot(spark, path).count() == 10


def test_registry(spark):
    path = new_path(spark, "r")
    assert registry.read_registry(spark, path).count() == 0
    artifact = spark.range(1)
    for rmse in (3.0, 2.0):
        registry.register(spark, path, "all", 24, "ridge", artifact, {"rmse": rmse}, ["a"])
    listed = registry.list_versions(registry.read_registry(spark, path), "aqi_all_24h").collect()
    assert [r.version for r in listed] == [2, 1]
    assert registry.latest_models(registry.read_registry(spark, path)).first().metrics == {"rmse": 2.0}


# --- models ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def samples(spark):
    """An autoregressive series with targets: persistence is beatable."""
    rng = np.random.default_rng(7)
    n, x = 900, [100.0]
    for _ in range(n + 80):
        x.append(100 + 0.97 * (x[-1] - 100) + rng.normal(0, 5))
    other = rng.normal(50, 10, n)
    rows = [(1, dt.datetime(2023, 7, 1) + dt.timedelta(hours=i), float(x[i]), float(other[i]),
             float(x[i + 24]), float(x[i + 48]), float(x[i + 72])) for i in range(n)]
    return spark.createDataFrame(rows, "station long, datetime timestamp_ntz, us_aqi double, pm10 double, "
                                 + ", ".join(f"{t} double" for t in TARGETS)).cache()


def test_ridge_equals_closed_form(spark, samples):
    blocks = cv_blocks(samples)
    models, stats = ridge.fit_ridge(blocks, ["us_aqi", "pm10"], weight=ridge.period_weight())
    got = {m.horizon: m for m in models.collect()}
    pdf = blocks.orderBy("datetime").toPandas()
    x = pdf[["us_aqi", "pm10"]].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    w = np.where(pdf["datetime"] < "2023-09-01", 0.3, 1.0)
    block = pdf["cv_block"].to_numpy()

    def solve(x, y, w, alpha):
        mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
        xc = x - mx
        b = np.linalg.solve((xc * w[:, None]).T @ xc + alpha * np.eye(x.shape[1]), (xc * w[:, None]).T @ (y - my))
        return my - mx @ b, b

    for h in (24, 48, 72):
        y = pdf[f"target_us_aqi_{h}h_ahead"].to_numpy()
        scores = []
        for alpha in ridge.ALPHAS:
            errors = []
            for i in (1, 2, 3):
                a, b = solve(x[block < i], y[block < i], w[block < i], alpha)
                errors.append(np.sqrt(np.mean((y[block == i] - a - x[block == i] @ b) ** 2)))
            scores.append(np.mean(errors))
        best = int(np.argmin(scores))
        a, b = solve(x, y, w, ridge.ALPHAS[best])
        assert got[h].alpha == pytest.approx(ridge.ALPHAS[best])
        assert got[h].cv_rmse == pytest.approx(scores[best])
        assert got[h].intercept == pytest.approx(a)
        assert got[h].coefficients == pytest.approx(list(b))


def test_ridge_equals_spark_linear_regression(spark, samples):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    features, label, alpha = ["us_aqi", "pm10"], TARGETS[0], 10.0
    blocks = cv_blocks(samples).withColumn("weight", ridge.period_weight())
    models, stats = ridge.fit_ridge(blocks, features, weight=F.col("weight"), alphas=[alpha])
    from airloom.operators.metrics import scale
    ready = VectorAssembler(inputCols=features, outputCol="features").transform(scale(blocks, stats, features))
    pdf = blocks.select("weight", label).toPandas()
    w, y = pdf["weight"], pdf[label]
    sd = np.sqrt(np.average((y - np.average(y, weights=w)) ** 2, weights=w))
    lr = LinearRegression(labelCol=label, weightCol="weight", standardization=False, solver="normal",
                          elasticNetParam=0.0, regParam=alpha * sd / w.sum()).fit(ready)
    ours = models.filter("horizon = 24").first()
    assert list(lr.coefficients) == pytest.approx(ours.coefficients, rel=1e-6)


def test_train_register_and_forecast(spark, samples):
    parts = {s: add_split(samples, months=0).filter(F.col("datetime") < "2023-08-01") if s == "train"
             else samples.filter(F.col("datetime") >= "2023-08-01") for s in ("train", "test")}
    trained = E.train_all(parts["train"].drop("split"), parts["test"],
                          candidates={"random_forest": [trees.Params("forest", trees=5, depth=3)], "boosted_trees": trees.draws(
                              "boosted", 2, grid={"trees": [3, 5], "depth": [2], "rate": [0.5], "lam": [1.0]})}, ledger=new_path(spark, "ledger"))
    assert {name for _, name in trained.artifacts} == {"ridge", "random_forest", "boosted_trees"}
    summary = trained.summary().collect()
    assert [r.horizon for r in sorted(summary, key=lambda r: r.horizon)] == ["24h", "48h", "72h"]
    assert all(r.r2_vs_baseline > 0 for r in summary)
    path = new_path(spark, "models")
    E.register_winners(trained, spark, path, "all")
    got = forecast(samples, E.load_bundles(spark, path, "all")).collect()
    assert sorted(r.horizon_hours for r in got) == [24, 48, 72]
    for r in got:
        assert r.target_datetime - r.reference_datetime == dt.timedelta(hours=r.horizon_hours)
    with pytest.raises(LookupError):
        E.load_bundles(spark, path, "elsewhere")


def test_shapley_adds_up_and_equals_linear(spark, samples):
    features = ["us_aqi", "pm10"]
    back = explain.background(samples, features)
    drawn = explain.sampled_background(back, features)
    last = samples.orderBy(F.desc("datetime")).limit(1)
    binned = trees.bin_rows(samples.withColumns({"weight": F.lit(1.0), "cv_block": F.lit(0)}), features, [TARGETS[0]])
    model = trees.Trainer(binned).fit(trees.Params("boosted", trees=3, depth=3, rate=0.5, lam=1.0), (0, 1), 0)
    got = explain.shapley_contributions(last, drawn, model, features)
    total = got.agg(F.sum("contribution")).first()[0]
    own = model.transform(last).first().prediction
    from pyspark.ml.functions import array_to_vector
    base = model.transform(drawn.withColumn("features", array_to_vector("_base"))).agg(F.avg("prediction")).first()[0]
    assert total == pytest.approx(own - base)


def test_linear_contributions_add_up(spark, samples):
    features, coefficient = ["us_aqi", "pm10"], {"us_aqi": F.lit(0.5), "pm10": F.lit(-2.0)}
    back = explain.background(samples, features)
    last = samples.orderBy(F.desc("datetime")).limit(1)
    total = explain.linear_contributions(last, back, coefficient, features).agg(F.sum("contribution")).first()[0]
    row, means = last.first(), back.agg(F.avg("us_aqi"), F.avg("pm10")).first()
    assert total == pytest.approx(0.5 * (row.us_aqi - means[0]) - 2.0 * (row.pm10 - means[1]))
    assert back.count() == 300


def test_perfect_forecast(spark):
    df = spark.createDataFrame([(1.0, 1.0), (5.0, 5.0)], "y double, p double")
    assert regression_metrics(df, "y", "p").first().r2 == 1.0


def test_rejected_rebuild_keeps_the_table(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0, 2.0]), path, buckets=2)
    with pytest.raises(ValueError, match="old table stays"):
        store.rebuild(series([1.0]).unionByName(series([2.0])), path, buckets=2)
    assert store.read_table(spark, path).count() == 2


def test_tables_without_rows(spark, series):
    path = new_path(spark, "t")
    assert store.rebuild(series([]), path, buckets=2).first()["rows"] == 0
    store.upsert(series([1.0, 2.0]), path)
    store.upsert(series([]), path)
    assert store.read_table(spark, path).count() == 2


def test_upsert_refuses_values_that_do_not_fit(spark, series):
    path = new_path(spark, "t")
    store.rebuild(series([1.0]).withColumn("day", F.lit(1)), path, buckets=2)
    for bad in (series([2.0]).withColumn("day", F.lit(5_000_000_000)), series([2.0], station=None).withColumn("day", F.lit(1))):
        with pytest.raises(ValueError, match="nothing is written"):
            store.upsert(bad, path)
    assert [tuple(r) for r in store.read_table(spark, path).select("us_aqi", "day").collect()] == [(1.0, 1)]


def test_csv_columns_are_found_by_name(spark, series):
    path = new_path(spark, "csv")
    rows = series([1.0, None]).withColumn("pm10", F.lit(20.0))
    rows.select("pm10", "us_aqi", "datetime", "station").write.option("header", True).csv(path)
    got = store.read_csv_by_name(spark, path, rows.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize("line", [
    '{"station": 1, "hourly": {"time": ["2024-01-01T00:00"', '{"station": 1, "hourly": {"time": ["2024-01-01T00:00"], "us_aqi": ["bad"]}}',
    '{"station": 1, "hourly": {"time": ["2024-01-01T00:00"], "us_aqi": [1.0, 2.0]}}', '{"hourly": {"time": ["2024-01-01T00:00"], "us_aqi": [1.0]}}',
    '{"station": 1, "hourly": {"time": [null], "us_aqi": [1.0]}}',
])
def test_broken_payloads_raise(spark, line):
    path = new_path(spark, "json")
    spark.createDataFrame([('{"station": 2, "hourly": {"time": ["2024-01-01T00:00"], "us_aqi": [3.0]}}',), (line,)], "value string").write.text(path)
    with pytest.raises(Exception):  # noqa: B017
        landing.read_payloads(spark, path, ["us_aqi"]).collect()


def test_refresh_of_a_table_that_does_not_exist(spark, series):
    path, raw = new_path(spark, "t"), series([float(i % 50) for i in range(300)])
    plan = lambda rows, holidays, seq: rows
    incremental.refresh(raw, path, None, plan=plan)
    assert store.read_table(spark, path).count() == 300
