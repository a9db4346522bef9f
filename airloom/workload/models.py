"""Splits, metrics, models, forecasts and explanations."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.aqi import alerts
from ..models import explain as X
from ..models import ridge, trees
from ..operators import metrics as M
from ..operators.recent import latest_row
from ..operators.windows import rolling, targets
from ..plans import forecast as P
from ..plans import splits as S
from ..plans import train as E
from ..plans import training as T
from ..plans.features import feature_columns, horizon_features
from ..schema import EDGE_SENSITIVE, HORIZONS, TARGETS
from ..session import new_path
from ..sources import store
from .catalog import comparable, comparable_sql, register
from .explore import case_sql
from .features import FEATURE_DOUBLES, FEATURES_SQL, INTEGERS, features
from .sql import cleaned_obs_sql, targets_sql
from .store import split_sql
from .views import obs, obs_sql
from .windows import cleaned

PREDICTORS = ["us_aqi", "pm2_5", "pm10", "wind_speed_10m", "temperature_2m", "precipitation"]
KEYS = "station datetime"
OUTLIER_END = "1996-09-01"  # the test tables run from 1995


def learnable(spark, sf_dir):
    """Cleaned predictors with all three targets, and their split. Training passes over the rows
    several times, so they are written once and read back."""
    df, hot = cleaned(spark, sf_dir, PREDICTORS)
    path = new_path(spark, "learnable")
    rolling(df, targets, hot=hot).na.drop(subset=TARGETS).write.parquet(path)
    return T.add_split(spark.read.parquet(path), "1 day")


LEARNABLE_SQL = split_sql(
    f"SELECT * FROM (SELECT *, {targets_sql()} FROM ({cleaned_obs_sql(PREDICTORS)}) AS c) AS f "
    f"WHERE {' AND '.join(t + ' IS NOT NULL' for t in TARGETS)}")


def refreshed_split(spark, sf_dir):
    """A stored table and the split made from it: twice, and once more after a compaction, which changes no row."""
    df, hot = cleaned(spark, sf_dir, PREDICTORS)
    table, snapshots = new_path(spark, "features"), new_path(spark, "snapshots")
    store.rebuild(rolling(df, targets, hot=hot), table, buckets=1)
    versions = {S.refresh_split(spark, table, snapshots, "1 day") for _ in range(2)}
    store.compact(spark, table)
    return snapshots, versions | {S.refresh_split(spark, table, snapshots, "1 day")}


@register("i6_p3_split_refresh", comparable_sql(
    f"SELECT *, 1 AS versions FROM ({LEARNABLE_SQL}) AS s", "station datetime split versions", ["us_aqi", *TARGETS]))
def split_refresh(spark, sf_dir):
    snapshots, versions = refreshed_split(spark, sf_dir)
    rows = store.read_snapshot(spark, snapshots).withColumn("versions", F.lit(len(versions)))
    return comparable(rows.select("station", "datetime", "split", "versions", "us_aqi", *TARGETS))


_PART_SQL = " UNION ALL ".join(
    f"SELECT station, datetime, '{split}' AS split, '{kind}' AS part, c AS name, v AS value FROM ({LEARNABLE_SQL}) AS s, "
    f"LATERAL (VALUES {', '.join(f"('{c}', {c})" for c in cols)}) AS x(c, v) WHERE split = '{split}'"
    for split in ("train", "test") for kind, cols in (("features", PREDICTORS), ("labels", TARGETS)))


@register("s10_feature_and_label_parts", comparable_sql(
    f"SELECT split, part, name, count(*) AS rows, min(datetime) AS first_datetime, max(datetime) AS last_datetime, avg(value) AS mean "
    f"FROM ({_PART_SQL}) AS p GROUP BY 1, 2, 3", "split part name rows first_datetime last_datetime", "mean"))
def split_parts(spark, sf_dir):
    parts = S.split_parts(spark, refreshed_split(spark, sf_dir)[0], PREDICTORS, TARGETS)
    long = []
    for where, part in parts._asdict().items():
        kind, split = where.split("_")
        cols = part.columns[2:]
        long.append(part.unpivot(["station", "datetime"], cols, "name", "value").select(
            "*", F.lit(split).alias("split"), F.lit(kind).alias("part")))
    return comparable(M.union_all(long).groupBy("split", "part", "name").agg(
        F.count("*").alias("rows"), F.min("datetime").alias("first_datetime"), F.max("datetime").alias("last_datetime"),
        F.avg("value").alias("mean")))


def metrics_sql(y: str, p: str) -> str:
    return (f"count(*) AS rows, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse, avg(abs({y} - {p})) AS mae, "
            f"1 - avg(({y} - {p}) * ({y} - {p})) / nullif(var_pop({y}), 0) AS r2")


def _by_horizon(body: str, where: str, extra: str = "") -> str:
    groups = "1, 2" if extra else "1"
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT {extra}{h} AS horizon, {metrics_sql(f'target_us_aqi_{h}h_ahead', 'us_aqi')} FROM ({body}) AS b "
        f"WHERE {where} GROUP BY {groups}) AS m{h}" for h in HORIZONS)


@register("a15_persistence_baseline", comparable_sql(
    _by_horizon(LEARNABLE_SQL, "split = 'test'"), "horizon rows", "rmse mae r2"))
def persistence(spark, sf_dir):
    return comparable(M.persistence_metrics(learnable(spark, sf_dir).filter("split = 'test'")))


@register("a15_persistence_by_station", comparable_sql(
    _by_horizon(f"SELECT * FROM ({FEATURES_SQL}) AS f WHERE aqi_rolling_mean_168h IS NOT NULL AND target_us_aqi_72h_ahead IS NOT NULL",
                "true", "station, "), "station horizon rows", "rmse mae r2"))
def persistence_by_station(spark, sf_dir):
    ready = T.training_ready(features(spark, sf_dir))
    return comparable(M.persistence_metrics(ready, ["station"]))


@register("a14_regression_metrics", comparable_sql(
    f"SELECT split, {metrics_sql('target_us_aqi_24h_ahead', '(0.5 * us_aqi + pm2_5)')} FROM ({LEARNABLE_SQL}) AS l GROUP BY 1",
    "split rows", "rmse mae r2"))
def metrics(spark, sf_dir):
    guess = learnable(spark, sf_dir).withColumn("guess", F.col("us_aqi") * 0.5 + F.col("pm2_5"))
    return comparable(M.regression_metrics(guess, "target_us_aqi_24h_ahead", "guess", ["split"]))


_STATS_SQL = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in PREDICTORS)
_TRAIN_SQL = f"SELECT * FROM ({LEARNABLE_SQL}) AS l WHERE split = 'train'"


@register("a16_scaler_statistics", comparable_sql(
    " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM ({_TRAIN_SQL}) AS t{i}"
                       for i, c in enumerate(PREDICTORS)), "feature", "mean std"))
def scaler(spark, sf_dir):
    stats = M.scaler_stats(learnable(spark, sf_dir).filter("split = 'train'"), PREDICTORS)
    return comparable(stats.select(F.explode("mean").alias("feature", "mean"), "std").withColumn(
        "std", F.col("std")[F.col("feature")]))


@register("f16_standardise", comparable_sql(
    f"SELECT station, datetime, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in PREDICTORS)} FROM ({LEARNABLE_SQL}) AS l "
    f"CROSS JOIN (SELECT {_STATS_SQL} FROM ({_TRAIN_SQL}) AS t) AS s", KEYS, PREDICTORS))
def standardised(spark, sf_dir):
    rows = learnable(spark, sf_dir)
    stats = M.scaler_stats(rows.filter("split = 'train'"), PREDICTORS)
    return comparable(M.scale(rows, stats, PREDICTORS).select("station", "datetime", *PREDICTORS))


@register("a17_split_bounds", comparable_sql(
    "SELECT *, rows / sum(rows) OVER () AS share FROM (SELECT split, min(datetime) AS first_datetime, max(datetime) AS last_datetime, "
    f"count(*) AS rows FROM ({LEARNABLE_SQL}) AS l GROUP BY 1) AS g", "split first_datetime last_datetime rows", "share"))
def bounds(spark, sf_dir):
    return comparable(T.split_bounds(learnable(spark, sf_dir)))


@register("f15_period_weights", comparable_sql(
    f"SELECT station, datetime, CASE WHEN datetime < TIMESTAMP '{OUTLIER_END}' THEN 0.3 ELSE 1.0 END AS weight FROM ({obs_sql(['us_aqi'])}) AS o",
    KEYS, "weight"))
def weights(spark, sf_dir):
    return comparable(obs(spark, sf_dir, ["us_aqi"]).select(
        "station", "datetime", ridge.period_weight(OUTLIER_END).alias("weight")))


# --- candidates: three fixed guesses stand in for models, so SQL can follow the selection ---------

GUESSES = {"persistence": "us_aqi", "halfway": "(us_aqi + 150) / 2", "particles": "pm2_5 * 6"}


def _candidate_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT {h} AS horizon, '{name}' AS model, sqrt(avg(CASE WHEN split = 'train' THEN (y - g) * (y - g) END)) AS cv_rmse, "
        "sqrt(avg(CASE WHEN split = 'test' THEN (y - g) * (y - g) END)) AS test_rmse, avg(CASE WHEN split = 'test' THEN abs(y - g) END) AS test_mae, "
        "1 - avg(CASE WHEN split = 'test' THEN (y - g) * (y - g) END) / var_pop(CASE WHEN split = 'test' THEN y END) AS test_r2 "
        f"FROM (SELECT split, target_us_aqi_{h}h_ahead AS y, {guess} AS g FROM l) AS c) AS c_{h}_{name}"
        for h in HORIZONS for name, guess in GUESSES.items())


def candidates(spark, sf_dir):
    cases = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.lit(n).alias("model"), F.col(f"target_us_aqi_{h}h_ahead").alias("y"),
                 F.expr(g).alias("g")) for h in HORIZONS for n, g in GUESSES.items()])
    long = learnable(spark, sf_dir).select("split", F.inline(cases))
    measured = M.regression_metrics(long, "y", "g", ["horizon", "model", "split"])
    cv = measured.filter("split = 'train'").select("horizon", "model", F.col("rmse").alias("cv_rmse"))
    test = measured.filter("split = 'test'").select(
        "horizon", "model", F.col("rmse").alias("test_rmse"), F.col("mae").alias("test_mae"), F.col("r2").alias("test_r2"))
    return cv.join(test, ["horizon", "model"])


_WITH_LEARNABLE = f"WITH l AS ({LEARNABLE_SQL}) "
_BEST_SQL = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY cv_rmse, model) AS rn FROM ({_candidate_sql()}) AS c) AS r WHERE rn = 1"


@register("a19_best_candidate", _WITH_LEARNABLE + comparable_sql(
    _BEST_SQL, "horizon model", "cv_rmse test_rmse test_mae test_r2"))
def best(spark, sf_dir):
    return comparable(M.best_candidates(candidates(spark, sf_dir)))


@register("a20_k11_evaluation_summary", _WITH_LEARNABLE + comparable_sql(
    "SELECT b.horizon || 'h' AS horizon, model AS best_model, round_even(test_rmse, 2) AS test_rmse, round_even(test_mae, 2) AS test_mae, "
    "round_even(test_r2, 3) AS test_r2, round_even(r2, 3) AS baseline_r2, round_even(test_r2 - r2, 3) AS r2_vs_baseline "
    f"FROM ({_BEST_SQL}) AS b JOIN ({_by_horizon('SELECT * FROM l', 'split = ' + chr(39) + 'test' + chr(39))}) AS p ON b.horizon = p.horizon",
    "horizon best_model", "test_rmse test_mae test_r2 baseline_r2 r2_vs_baseline"))
def summary(spark, sf_dir):
    baseline = M.persistence_metrics(learnable(spark, sf_dir).filter("split = 'test'"))
    rows = M.evaluation_summary(M.best_candidates(candidates(spark, sf_dir)), baseline)
    path = new_path(spark, "summary")
    store.write_results(rows, path)
    return comparable(spark.read.parquet(path))


# --- ridge ------------------------------------------------------------------------------------

FEW = ["us_aqi", "pm2_5"]
_POSITIONS = ["1", "us_aqi", "pm2_5", "target_us_aqi_24h_ahead"]


@register("m1_product_sums", comparable_sql(" UNION ALL ".join(
    f"SELECT cv_block AS block, {w} AS weighted, {i * 4 + j} AS position, sum(CAST({a} AS DOUBLE) * {b} * "
    f"{'CASE WHEN datetime < TIMESTAMP ' + chr(39) + OUTLIER_END + chr(39) + ' THEN 0.3 ELSE 1.0 END' if w else '1'}) AS value "
    f"FROM l GROUP BY 1" for w in (0, 1) for i, a in enumerate(_POSITIONS) for j, b in enumerate(_POSITIONS)),
    "block weighted position", "value").replace("SELECT block", (
        "WITH l AS (SELECT *, CAST(greatest(0, ceil((rn - (n - 3 * (n // 4))) / CAST(greatest(n // 4, 1) AS DOUBLE))) AS INTEGER) AS cv_block "
        "FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime) AS rn, count(*) OVER (PARTITION BY station) AS n "
        f"FROM ({_TRAIN_SQL}) AS t) AS r) SELECT block"), 1))
def gram(spark, sf_dir):
    """The sums every ridge fit is solved from."""
    rows = T.cv_blocks(learnable(spark, sf_dir).filter("split = 'train'"))
    sums = ridge.product_sums(rows, FEW, ["target_us_aqi_24h_ahead"], F.lit("all"), ridge.period_weight(OUTLIER_END))
    return comparable(sums.drop("model_group"))


def fitted(spark, sf_dir):
    rows = learnable(spark, sf_dir)
    train = T.pooled_cv_blocks(rows.filter("split = 'train'"))
    models, stats = ridge.fit_ridge(train, PREDICTORS, weight=ridge.period_weight(OUTLIER_END))
    return rows, models, stats


def _sums(weight: str) -> str:
    """n, x1, x2, y and all products, as SQL sums."""
    terms = {"n": "1", "x1": "x1", "x2": "x2", "y": "y", "x11": "x1 * x1", "x12": "x1 * x2", "x22": "x2 * x2",
             "x1y": "x1 * y", "x2y": "x2 * y", "yy": "y * y"}
    prefix = "w_" if weight != "1" else "u_"
    return ", ".join(f"sum({weight} * {t}) AS {prefix}{n}" for n, t in terms.items())


def _fit_sql(source: str, keep: str) -> str:
    """Two-feature ridge by Cramer's rule from weighted sums and a penalty."""
    return (
        f"SELECT {keep}, b1, b2, (w_y - b1 * w_x1 - b2 * w_x2) / w_n AS b0 FROM (SELECT *, "
        "(a22 * c1 - a12 * c2) / (a11 * a22 - a12 * a12) AS b1, (a11 * c2 - a12 * c1) / (a11 * a22 - a12 * a12) AS b2 FROM ("
        "SELECT *, w_x11 - w_x1 * w_x1 / w_n + alpha AS a11, w_x12 - w_x1 * w_x2 / w_n AS a12, w_x22 - w_x2 * w_x2 / w_n + alpha AS a22, "
        f"w_x1y - w_x1 * w_y / w_n AS c1, w_x2y - w_x2 * w_y / w_n AS c2 FROM ({source}) AS g) AS n) AS s")


_TERMS = ["n", "x1", "x2", "y", "x11", "x12", "x22", "x1y", "x2y", "yy"]
_RIDGE_SQL = (
    "WITH t AS (SELECT *, CAST(greatest(0, ceil((rn - (n - 3 * (n // 4))) / CAST(greatest(n // 4, 1) AS DOUBLE))) AS INTEGER) AS cv_block "
    "FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime) AS rn, count(*) OVER (PARTITION BY station) AS n "
    f"FROM ({_TRAIN_SQL}) AS t0) AS r), "
    "s AS (SELECT avg(us_aqi) AS m1, stddev_pop(us_aqi) AS s1, avg(pm2_5) AS m2, stddev_pop(pm2_5) AS s2 FROM t), "
    f"z AS (SELECT cv_block, CAST(CASE WHEN datetime < TIMESTAMP '{OUTLIER_END}' THEN 0.3 ELSE 1.0 END AS DOUBLE) AS w, "
    "(us_aqi - m1) / s1 AS x1, (pm2_5 - m2) / s2 AS x2, horizon, CASE horizon WHEN 24 THEN target_us_aqi_24h_ahead "
    "WHEN 48 THEN target_us_aqi_48h_ahead ELSE target_us_aqi_72h_ahead END AS y "
    "FROM t CROSS JOIN s CROSS JOIN (VALUES (24), (48), (72)) AS h(horizon)), "
    f"b AS (SELECT horizon, cv_block, {_sums('w')}, {_sums('1')} FROM z GROUP BY 1, 2), "
    "p AS (SELECT power(10.0, k * 0.25 - 3) AS alpha FROM range(25) AS k(k)), "
    "f AS (SELECT test.horizon, test.cv_block AS fold, " + ", ".join(f"sum(past.w_{x}) AS w_{x}" for x in _TERMS) + ", "
    + ", ".join(f"any_value(test.u_{x}) AS u_{x}" for x in _TERMS)
    + " FROM b AS test JOIN b AS past ON test.horizon = past.horizon AND past.cv_block < test.cv_block GROUP BY 1, 2), "
    "e AS (" + _fit_sql("SELECT * FROM f CROSS JOIN p", "horizon, fold, alpha, " + ", ".join(f"u_{x}" for x in _TERMS)) + "), "
    "c AS (SELECT horizon, alpha, avg(sqrt((u_yy - 2 * b0 * u_y - 2 * b1 * u_x1y - 2 * b2 * u_x2y + u_n * b0 * b0 + 2 * b0 * b1 * u_x1 "
    "+ 2 * b0 * b2 * u_x2 + b1 * b1 * u_x11 + 2 * b1 * b2 * u_x12 + b2 * b2 * u_x22) / u_n)) AS cv_rmse FROM e GROUP BY 1, 2), "
    "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY cv_rmse, alpha) AS rn FROM c) AS r WHERE rn = 1), "
    "total AS (SELECT horizon, " + ", ".join(f"sum(w_{x}) AS w_{x}" for x in _TERMS) + " FROM b GROUP BY 1) "
)


@register("m1_ridge_two_features", _RIDGE_SQL + comparable_sql(
    _fit_sql("SELECT total.*, best.alpha, best.cv_rmse FROM total JOIN best ON total.horizon = best.horizon", "horizon, alpha, cv_rmse"),
    "horizon", "alpha cv_rmse b0 b1 b2"))
def ridge_two_features(spark, sf_dir):
    """All folds, penalties and horizons for two predictors: small enough for SQL to follow."""
    train = T.cv_blocks(learnable(spark, sf_dir).filter("split = 'train'"))
    models, _ = ridge.fit_ridge(train, FEW, weight=ridge.period_weight(OUTLIER_END))
    return comparable(models.select(
        "horizon", "alpha", "cv_rmse", F.col("intercept").alias("b0"),
        F.col("coefficients")[0].alias("b1"), F.col("coefficients")[1].alias("b2")))


@register("m1_ridge_cross_validated")
def ridge_models(spark, sf_dir):
    _, models, _ = fitted(spark, sf_dir)
    return comparable(models.select("horizon", "algorithm", "alpha", "cv_rmse", "intercept", "left_out", F.posexplode(
        "coefficients").alias("feature_index", "coefficient")))


@register("m1_ridge_by_region")
def ridge_by_group(spark, sf_dir):
    """One model per station group: here, four groups by supplier key."""
    train = T.cv_blocks(learnable(spark, sf_dir).filter("split = 'train'"))
    group = F.concat(F.lit("region_"), F.pmod(F.col("station"), F.lit(4)).cast("string"))
    models, _ = ridge.fit_ridge(train, PREDICTORS, group=group)
    return comparable(models.select("model_group", "horizon", "alpha", "cv_rmse", "intercept", "left_out"))


# --- trees ------------------------------------------------------------------------------------

def trainable(spark, sf_dir, table=None):
    """Training-ready rows of the whole feature table and their split, written once like those of learnable. ``table``: the
    feature table, where it is written already."""
    if table is None:
        path = new_path(spark, "trainable")
        T.training_ready(features(spark, sf_dir)).write.parquet(path)
        return T.add_split(spark.read.parquet(path), "1 day")
    return T.add_split(T.training_ready(table), "1 day")


def written_features(spark, sf_dir):
    """The feature table, written once for all that read it."""
    path = new_path(spark, "features")
    features(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def parts(spark, sf_dir, table=None):
    rows = trainable(spark, sf_dir, table)
    return [rows.filter(F.col("split") == s).drop("split") for s in ("train", "test")]


MODEL_FEATURES = [*INTEGERS, *[c for c in FEATURE_DOUBLES if c not in TARGETS]]
_READY_SQL = split_sql(f"SELECT * FROM ({FEATURES_SQL}) AS f WHERE {' AND '.join(c + ' IS NOT NULL' for c in EDGE_SENSITIVE)}")
_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)


def fitted_wide(spark, sf_dir):
    """Ridge on every feature of the table, for all horizons: training rows, models, scaler, features by horizon."""
    train = T.pooled_cv_blocks(parts(spark, sf_dir)[0]).withColumn("weight", ridge.period_weight(OUTLIER_END))
    columns = feature_columns(train.drop("weight", "cv_block"))
    used = {h: horizon_features(columns, h) for h in HORIZONS}
    models, stats = ridge.fit_ridge(train, columns, weight=F.col("weight"), used=used)
    # a row per horizon: keep the fitted numbers, not the plan behind them
    return train, spark.createDataFrame(models.collect(), ridge.MODEL_SCHEMA), stats, columns, used


@register("m1_ridge_all_features", comparable_sql(
    f"SELECT h AS horizon, feature, count(*) AS rows, 0.0 AS gradient FROM ({_READY_SQL}) AS t, "
    f"(VALUES {', '.join(f'({h})' for h in HORIZONS)}) AS v(h), "
    f"(VALUES {', '.join(f"('{c}')" for c in ['intercept', *MODEL_FEATURES])}) AS n(feature) "
    f"WHERE split = 'train' AND {_WHOLE} GROUP BY 1, 2", "horizon feature rows", "gradient"))
def ridge_all_features(spark, sf_dir):
    """The slopes of the error at the fitted models, over all rows: 0 is what the SQL asks of each."""
    train, models, stats, columns, used = fitted_wide(spark, sf_dir)
    slopes = ridge.optimality(train, models, stats, columns, used, F.col("weight"))
    return comparable(slopes.drop("coefficient"))


FOREST = trees.Params("forest", trees=100, depth=10, min_rows=5, feature_share="sqrt")
BOOSTED = trees.Params("boosted", trees=100, depth=4, min_rows=5, feature_share=0.8, rate=0.1, row_share=0.8, alpha=0.1, lam=1.0)


def tree_table(spark, sf_dir, table=None):
    """The feature table's training rows, binned for trees that look 24 hours ahead, and the features' names."""
    train, _ = parts(spark, sf_dir, table)
    names = horizon_features(feature_columns(train), 24)
    rows = T.pooled_cv_blocks(train).withColumn("weight", ridge.period_weight(OUTLIER_END))
    return trees.Trainer(trees.bin_rows(rows, names, ["target_us_aqi_24h_ahead"])), names


def _fitted_trees(spark, sf_dir, params, name):
    """One candidate: its error by folds, and what its features are worth in the model of all rows."""
    trainer, names = tree_table(spark, sf_dir)
    model, _, cv_rmse = trees.tune(trainer, [params], names, "target_us_aqi_24h_ahead")
    return model.importance().select(F.lit(name).alias("model"), "feature", "importance", F.lit(cv_rmse).alias("cv_rmse"))


@register("m2_random_forest")
def forest(spark, sf_dir):
    return _fitted_trees(spark, sf_dir, FOREST, "random_forest")


@register("m3_boosted_trees")
def boosted(spark, sf_dir):
    return _fitted_trees(spark, sf_dir, BOOSTED, "boosted_trees")


@register("m6_t3_feature_importance")
def importance(spark, sf_dir):
    """Of the ridge models on all features, for each horizon."""
    _, models, _, _, used = fitted_wide(spark, sf_dir)
    return comparable(M.union_all([
        X.importance(models.filter(F.col("horizon") == h), F.col("coefficients"), used[h], 10).withColumn("horizon", F.lit(h))
        for h in HORIZONS]))


@register("m5_e3_train_and_select")
def trained(spark, sf_dir):
    """Ridge over all its penalties, one forest and one boosted model, for every horizon."""
    train, test = parts(spark, sf_dir)
    return E.train_all(train, test, candidates={"random_forest": [FOREST], "boosted_trees": [BOOSTED]}).summary()


@register("k12_m7_registered_forecast")
def registered_forecast(spark, sf_dir):
    """Train, register the winners, load the latest versions and score every station. The feature table is written once for both."""
    path, table = new_path(spark, "models"), written_features(spark, sf_dir)
    train, test = parts(spark, sf_dir, table)
    E.register_winners(E.train_all(train, test, candidates={"boosted_trees": [BOOSTED]}), spark, path, "all")
    return comparable(P.forecast(table, E.load_bundles(spark, path, "all")))


# --- forecasts from a fixed linear model: SQL can follow every step ----------------------------

LINEAR = {"us_aqi": 0.61803399, "pm2_5": 1.41421356, "pm10": -0.57721567}
INTERCEPT = {24: 20.25, 48: 35.5, 72: -10.75}
LINEAR_FEATURES = list(LINEAR)


def linear_bundles():
    def scorer(intercept):
        def score(rows):
            total = F.lit(intercept)
            for c, b in LINEAR.items():
                total = total + F.col(c) * b
            return rows.withColumn("prediction", total)
        return score
    return [P.Bundle(h, "linear", LINEAR_FEATURES, scorer(i)) for h, i in INTERCEPT.items()]


_LINEAR_SQL = " + ".join(f"{c} * {b}" for c, b in LINEAR.items())
_NEWEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn FROM ({}) AS o) AS r WHERE rn = 1"
_LAST_SQL = _NEWEST.format(obs_sql(LINEAR_FEATURES))
_FORECAST_SQL = (
    "SELECT station, datetime AS reference_datetime, us_aqi AS current_aqi, h AS horizon_hours, "
    "datetime + to_hours(CAST(h AS INTEGER)) AS target_datetime, "
    f"round_even({_LINEAR_SQL} + i, 1) AS predicted_aqi, 'linear' AS algorithm FROM ({_NEWEST.format(cleaned_obs_sql(LINEAR_FEATURES))}) AS o "
    f"CROSS JOIN (VALUES {', '.join(f'({h}, {i})' for h, i in INTERCEPT.items())}) AS v(h, i) "
    f"WHERE {' AND '.join(c + ' IS NOT NULL' for c in LINEAR_FEATURES)}")


def forecasts(spark, sf_dir):
    """From a stored table of cleaned rows, as a serving job reads it: the newest row of each station, from the
    months that hold one."""
    path = new_path(spark, "serving")
    store.rebuild(cleaned(spark, sf_dir, LINEAR_FEATURES)[0], path, buckets=1)
    return P.forecast_stored(spark, path, linear_bundles())[0]


@register("m7_batch_scoring", comparable_sql(
    _FORECAST_SQL, "station reference_datetime horizon_hours target_datetime algorithm", "current_aqi predicted_aqi"))
def scored(spark, sf_dir):
    return comparable(forecasts(spark, sf_dir))


@register("m7_p8_skipped_stations",
          f"SELECT station, datetime FROM ({_LAST_SQL}) AS o WHERE {' OR '.join(c + ' IS NULL' for c in LINEAR_FEATURES)}")
def skipped(spark, sf_dir):
    return P.scoreable(obs(spark, sf_dir, LINEAR_FEATURES), LINEAR_FEATURES)[1]


@register("m8_enriched_forecast", comparable_sql(
    f"SELECT *, {case_sql('predicted_aqi', 2)} AS category, {case_sql('current_aqi', 2)} AS current_category FROM ({_FORECAST_SQL}) AS f",
    "station horizon_hours category current_category", "current_aqi predicted_aqi"))
def enriched(spark, sf_dir):
    rows = P.enrich(forecasts(spark, sf_dir))
    return comparable(rows.select("station", "horizon_hours", "category", "current_category", "current_aqi", "predicted_aqi"))


@register("m8_forecast_alerts", comparable_sql(
    "SELECT station, target_datetime, horizon_hours || 'h' AS horizon, "
    "CASE WHEN predicted_aqi >= 200 THEN 'severe' ELSE 'warning' END AS severity, predicted_aqi AS value, "
    f"{case_sql('predicted_aqi', 2)} AS category FROM ({_FORECAST_SQL}) AS f WHERE predicted_aqi >= 150",
    "station target_datetime horizon severity category", "value"))
def forecast_alerts(spark, sf_dir):
    return comparable(alerts(forecasts(spark, sf_dir)).drop("message"))


# --- explanations -------------------------------------------------------------------------------

def coefficient():
    return {c: F.lit(b) for c, b in LINEAR.items()}


_BACK_SQL = (
    "SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime) AS background_row FROM (SELECT *, "
    "row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS kept FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn FROM ({cleaned_obs_sql(LINEAR_FEATURES)}) AS o) AS r "
    f"WHERE rn <= 600 AND {' AND '.join(c + ' IS NOT NULL' for c in LINEAR_FEATURES)}) AS k WHERE kept <= 300")
_BACK_MEANS = ", ".join(f"avg({c}) AS m_{c}" for c in LINEAR_FEATURES)
_CLEAN_LAST = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY datetime DESC) AS rn "
               f"FROM ({cleaned_obs_sql(LINEAR_FEATURES)}) AS c) AS r WHERE rn = 1")
_LOCAL_SQL = "WITH back AS (" + _BACK_SQL + f"), means AS (SELECT station, {_BACK_MEANS} FROM back GROUP BY 1) " + " UNION ALL ".join(
    f"SELECT i.station, '{c}' AS feature, {b} * (i.{c} - m.m_{c}) AS contribution FROM ({_CLEAN_LAST}) AS i "
    "JOIN means AS m ON i.station = m.station" for c, b in LINEAR.items())
_GLOBAL_SQL = "WITH back AS (" + _BACK_SQL + f"), means AS (SELECT station, {_BACK_MEANS} FROM back GROUP BY 1) " + " UNION ALL ".join(
    f"SELECT b.station, '{c}' AS feature, avg(abs({b} * (b.{c} - m.m_{c}))) AS mean_abs_contribution FROM back AS b "
    "JOIN means AS m ON b.station = m.station WHERE background_row <= 100 GROUP BY 1" for c, b in LINEAR.items())


def explained(spark, sf_dir):
    df, _ = cleaned(spark, sf_dir, LINEAR_FEATURES)
    return latest_row(df), X.background(df, LINEAR_FEATURES)


@register("m9_linear_contributions", comparable_sql(_LOCAL_SQL, "station feature", "contribution"))
def local_contributions(spark, sf_dir):
    rows, back = explained(spark, sf_dir)
    return comparable(X.linear_contributions(rows, back, coefficient(), LINEAR_FEATURES))


@register("a18_global_importance", comparable_sql(_GLOBAL_SQL, "station feature", "mean_abs_contribution"))
def global_importance(spark, sf_dir):
    _, back = explained(spark, sf_dir)
    return comparable(X.mean_contributions(back, coefficient(), LINEAR_FEATURES))


@register("t4_top_contributions", comparable_sql(
    "SELECT *, row_number() OVER (PARTITION BY station ORDER BY abs(contribution) DESC, feature) AS rank "
    f"FROM ({_LOCAL_SQL}) AS c", "station feature rank", "contribution") + " WHERE rank <= 2")
def top_contributions(spark, sf_dir):
    rows, back = explained(spark, sf_dir)
    local = X.linear_contributions(rows, back, coefficient(), LINEAR_FEATURES)
    return comparable(X.top_contributions(local, ["station"], "contribution", 2))


def boosted_on_features(spark, sf_dir):
    """The feature table, written once for training and explanation, boosted trees fitted on it, and the features' names."""
    table = written_features(spark, sf_dir)
    trainer, names = tree_table(spark, sf_dir, table)
    return table, trainer.fit(BOOSTED, tuple(range(len(names))), 0), names


@register("m10_sampled_shapley_contributions")
def shapley(spark, sf_dir):
    """Contributions for a boosted-tree forecast of every station with a complete row."""
    table, model, names = boosted_on_features(spark, sf_dir)
    back = X.sampled_background(X.background(table, names), names)
    return comparable(X.shapley_contributions(latest_row(table).na.drop(subset=names), back, model, names))


class LinearModel:
    """The fixed linear model as one that scores a vector column."""

    def transform(self, df):
        products = F.zip_with(vector_to_array("features"), F.lit(list(LINEAR.values())), lambda a, b: a * b)
        return df.withColumn("prediction", F.aggregate(products, F.lit(INTERCEPT[24]), lambda s, v: s + v))


def linear_shapley(spark, sf_dir):
    """Every background row is drawn, so that the contributions have a closed form."""
    rows, back = explained(spark, sf_dir)
    drawn = X.sampled_background(back, LINEAR_FEATURES, X.BACKGROUND_ROWS)
    return X.shapley_within(rows.na.drop(subset=LINEAR_FEATURES), drawn, LinearModel(), LINEAR_FEATURES, -1.0, first=64)


_SHAPLEY_SQL = "WITH back AS (" + _BACK_SQL + ") " + " UNION ALL ".join(
    f"SELECT i.station, '{c}' AS feature, avg({b} * (i.{c} - b.{c})) AS contribution, count(*) AS draws, "
    f"stddev_samp({b} * (i.{c} - b.{c})) / sqrt(count(*)) AS standard_error, "
    f"avg({INTERCEPT[24]} + {' + '.join(f'{w} * b.{f}' for f, w in LINEAR.items())}) AS base, "
    f"any_value({INTERCEPT[24]} + {' + '.join(f'{w} * i.{f}' for f, w in LINEAR.items())}) AS prediction "
    f"FROM ({_CLEAN_LAST}) AS i JOIN back AS b ON i.station = b.station WHERE "
    f"{' AND '.join(f'i.{f} IS NOT NULL' for f in LINEAR)} GROUP BY 1" for c, b in LINEAR.items())


@register("m10_shapley_of_linear_model", comparable_sql(
    _SHAPLEY_SQL, "station feature draws", "contribution standard_error base prediction"))
def shapley_of_linear(spark, sf_dir):
    return comparable(linear_shapley(spark, sf_dir))


@register("m10_a18_shapley_global", comparable_sql(
    f"SELECT feature, avg(abs(contribution)) AS mean_abs_contribution, count(*) AS stations FROM ({_SHAPLEY_SQL}) AS s GROUP BY 1",
    "feature stations", "mean_abs_contribution"))
def shapley_global(spark, sf_dir):
    return comparable(X.global_contributions(linear_shapley(spark, sf_dir)))


SHAPLEY_TOLERANCE = 5.0  #: AQI points


@register("m10_shapley_adds_up", comparable_sql(
    f"SELECT station, {len(MODEL_FEATURES)} AS features, 0.0 AS gap FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY "
    f"datetime DESC) AS rn FROM ({FEATURES_SQL}) AS f) AS r WHERE rn = 1 AND {_WHOLE}", "station features", "gap"))
def shapley_adds_up(spark, sf_dir):
    """Boosted trees on the feature table: base and contributions of each station against its prediction."""
    table, model, names = boosted_on_features(spark, sf_dir)
    back = X.sampled_background(X.background(table, names), names)
    parts_ = X.shapley_within(latest_row(table).na.drop(subset=names), back, model, names, SHAPLEY_TOLERANCE)
    gap = F.first("base") + F.sum("contribution") - F.first("prediction")
    return comparable(parts_.groupBy("station").agg(F.count("*").alias("features"), F.abs(gap).alias("gap")))
