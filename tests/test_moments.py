"""Correlations from sums of products per task, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from commentscope.operators import selection as Z
from commentscope.plans import moments


def pairwise(x, y):
    out = np.full((x.shape[1], y.shape[1]), np.nan)
    for i in range(x.shape[1]):
        for j in range(y.shape[1]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(y[:, j])
            a, b = x[both, i], y[both, j]
            if len(a) > 1 and a.min() < a.max() and b.min() < b.max():
                out[i, j] = np.corrcoef(a, b)[0, 1]
    return out


def rows_of(x):
    return [[None if np.isnan(v) else float(v) for v in r] for r in x]


def filled(found, shape):
    out = np.full(shape, np.inf)
    for r in found.collect():
        assert out[r["i"], r["j"]] == np.inf
        out[r["i"], r["j"]] = np.nan if r["r"] is None else r["r"]
    return out


def table(rng, n, d):
    x = rng.normal(size=(n, d)) * rng.uniform(0.01, 100, d) + rng.uniform(-1e6, 1e6, d)
    x[rng.random((n, d)) < 0.1] = np.nan
    x[:, 0] = 7.1
    x[:, 1] = np.nan
    x[1:, 2] = np.nan
    x[0, 3] = 1e12  # an early value far from the rest, which the shift takes
    x[1:, 3] = rng.normal(size=n - 1)
    x[2:, 4] = 0.3
    x[:2, 4] = np.nan
    return x


def test_blocks_gaps_constants_and_far_shifts(spark, monkeypatch):
    monkeypatch.setattr(moments, "BLOCK", 5)
    monkeypatch.setattr(moments, "BLOCKS", 2)
    rng = np.random.default_rng(1)
    x, y = table(rng, 120, 13), rng.integers(0, 2, (120, 7)).astype(float)
    y[:, 6] = 1
    y[3, 2] = np.nan
    df = spark.createDataFrame(list(zip(rows_of(x), rows_of(y))), "x array<double>, y array<double>").repartition(3)
    got = filled(moments.correlations(df, "x", 13, "y", 7), (13, 7))
    np.testing.assert_allclose(got, pairwise(x, y), atol=1e-9)
    got = filled(moments.correlations(df, "x", 13), (13, 13))
    np.testing.assert_allclose(got, pairwise(x, x), atol=1e-9)


def test_odd_arrays_are_unknown_where_they_lack_entries(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([2.0, 1.0],), (None,), ([4.0, 9.0, 1.0, 5.0],), ([],)], "x array<double>")
    got = filled(moments.correlations(df, "x", 3), (3, 3))
    full = np.array([[1, 2, 3], [2, 1, np.nan], [4, 9, 1]])
    np.testing.assert_allclose(got, pairwise(full, full), atol=1e-12)
    assert all(r["r"] is None for r in moments.correlations(df.limit(0), "x", 3).collect())


def test_768_dimensions_with_gaps_and_no_row_per_entry(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 768)), rng.integers(0, 2, (300, 2))
    x[rng.random(x.shape) < 0.05] = np.nan
    names = [f"d{i}" for i in range(768)]
    df = spark.createDataFrame([(v, int(a), int(b)) for v, (a, b) in zip(rows_of(x), y)], "v array<double>, a int, b int").repartition(4)
    found = Z.vector_label_correlation(df, "v", names, ["a", "b"])
    got = {(r["feature"], r["label"]): r["r"] for r in found.collect()}
    want = pairwise(x, y.astype(float))
    assert len(got) == 768 * 2
    assert all(got[f"d{i}", l] == pytest.approx(want[i, j], abs=1e-9) for i in range(768) for j, l in enumerate("ab"))
    sums = moments.block_sums(df.select("v", F.array("a", "b").alias("y")), "v", "y", (np.zeros(768), np.zeros(2)))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and plan.count("Exchange ") <= 2


def test_matrix_agrees_with_label_correlation(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "p double, q double, r double, s double")
    got = {(r["a"], r["b"]): r["r"] for r in Z.correlation_matrix(df, ["p", "q", "r", "s"]).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 16 and all(got[a, b] == pytest.approx(want[i, j], abs=1e-12) for i, a in enumerate("pqrs") for j, b in enumerate("pqrs"))


@pytest.mark.parametrize("block", [1, 4, 7, 1024])
def test_collinearity_choice_in_blocks_of_ranks(spark, block):
    rng = np.random.default_rng(9)
    names = [f"f{i:02d}" for i in range(20)]
    clash = np.triu(rng.random((20, 20)) < 0.2, 1)
    clash |= clash.T
    matrix = spark.createDataFrame([(a, b, 1.0 if i == j else 0.95 * float(clash[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)], "a string, b string, r double")
    power = [None if i == 3 else round(float(x), 1) for i, x in enumerate(rng.random(20))]
    strength = spark.createDataFrame(list(zip(names, power)), "feature string, max_abs_r double")
    order = sorted(range(20), key=lambda i: (power[i] is None, -(power[i] or 0), names[i]))
    kept = []
    for i in order:
        if not any(clash[i, j] for j in kept):
            kept.append(i)
    got = {r["feature"]: r["kept"] for r in Z.drop_collinear(matrix, strength, 0.9, block).collect()}
    assert got == {n: i in kept for i, n in enumerate(names)}
