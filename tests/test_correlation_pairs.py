"""Correlations of all pairs, against Spark's own."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.operators import explore as E


@pytest.fixture(scope="module")
def readings(spark):
    """Columns with gaps of their own, a large offset, a copy and a NaN."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a, b = rng.normal(), rng.normal()
        line = [a, 1e7 + a + b, a * b, -2 * a, a + 3 * b]
        rows.append([i, *[None if rng.random() < 0.2 else float(v) for v in line], math.nan if i == 7 else float(b)])
    return spark.createDataFrame(rows, "id long, us_aqi double, far double, both double, copy double, mixed double, odd double").repartition(7)


def test_correlation_matrix_of_pairs(readings, monkeypatch):
    """Against Spark's corr of each pair; the aggregate itself asks for one corr a column at most."""
    cols = ["us_aqi", "far", "both", "copy", "mixed", "odd"]
    want = {(a, b): readings.agg(F.corr(a, b)).first()[0] for a in cols for b in cols}
    calls, real = [], F.corr
    monkeypatch.setattr(E.F, "corr", lambda *x: calls.append(x) or real(*x))
    got = {(r.column_a, r.column_b): r["corr"] for r in E.correlation_matrix(readings, cols=cols).collect()}
    assert len(calls) <= len(cols) and got.keys() == want.keys()
    for pair, value in want.items():
        assert got[pair] == pytest.approx(value, abs=1e-9, nan_ok=True)


def test_correlation_matrix_without_pairs(spark):
    """No rows in common, and one row: null like Spark's corr."""
    rows = spark.createDataFrame([(1.0, None, 2.0), (2.0, None, None), (None, 3.0, None), (None, 4.0, None)], "us_aqi double, b double, c double")
    cols = ["us_aqi", "b", "c"]
    got = {(r.column_a, r.column_b): r["corr"] for r in E.correlation_matrix(rows, cols=cols).collect()}
    assert got == {(a, b): rows.agg(F.corr(a, b)).first()[0] for a in cols for b in cols}
