"""Exact quantiles by selection, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from commentscope.operators import corpus as C
from commentscope.plans import quantiles as Q

PROBS = [0.0, 0.001, 0.25, 0.5, 0.5001, 0.77, 0.999, 1.0]


def long_of(spark, columns):
    parts = [spark.createDataFrame([(float(x),) for x in v], "value double").withColumn("feature", F.lit(k)) for k, v in columns.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.repartition(6)


@pytest.fixture(scope="module")
def columns():
    draw = np.random.default_rng(3)
    return {"normal": draw.normal(size=60_000), "ties": draw.integers(0, 5, 40_000), "hot": np.r_[np.zeros(30_000), draw.normal(size=30_000)],
            "sorted": np.arange(25_000) ** 2, "two": [1.0, 2.0], "one": [5.0], "few": draw.normal(size=9_999), "just": draw.normal(size=10_000)}


def test_matches_numpy(spark, columns):
    df = long_of(spark, columns).unionByName(spark.createDataFrame([("none", None), ("two", None)], "feature string, value double"))
    got = {r["feature"]: r for r in Q.exact_quantiles(df, PROBS).collect()}
    assert got.keys() == columns.keys()
    for k, v in columns.items():
        np.testing.assert_allclose([got[k][f"q{i}"] for i in range(len(PROBS))], np.quantile(v, PROBS), rtol=1e-12, atol=1e-12, err_msg=k)
        assert got[k]["n"] == len(v)
    turned = Q.exact_quantiles(df, [0.9, 0.1]).where("feature = 'normal'").first()
    np.testing.assert_allclose([turned["q0"], turned["q1"]], np.quantile(columns["normal"], [0.9, 0.1]))


def test_a_missed_bracket_is_settled_over_all_values(spark, columns):
    df = long_of(spark, {k: columns[k] for k in ("normal", "few")})
    spans = F.array(*[F.struct(F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi")) for lo, hi in ((-9, -8), (0, 9))])
    bracketed = df.select("feature").distinct().withColumn("__brackets", spans)
    got = {r["feature"]: r for r in Q.quantiles_in_brackets(df, bracketed, [0.25, 0.5]).collect()}
    for k in ("normal", "few"):
        np.testing.assert_allclose([got[k]["q0"], got[k]["q1"]], np.quantile(columns[k], [0.25, 0.5]))


def test_only_values_next_to_quantiles_are_shuffled(spark, columns, monkeypatch):
    seen = []
    keep = Q.quantiles_of_counts
    monkeypatch.setattr(Q, "quantiles_of_counts", lambda counts, *a: (seen.append(counts.count()), keep(counts, *a))[1])
    Q.exact_quantiles(long_of(spark, {"normal": columns["normal"]}), [0.25, 0.5, 0.75]).collect()
    # a bracket reaches three ten-thousandths of the rows to each side, give or take the sketch's error
    assert len(seen) == 1 and seen[0] <= 3 * (8 * 6 + 2) + 4


def test_summary_of_many_values(spark, columns):
    got = {r["feature"]: r for r in C.summary(long_of(spark, columns)).collect()}
    for k, v in columns.items():
        r, v = got[k], np.array(v, float)
        want = [len(v), v.mean(), v.std(ddof=1) if len(v) > 1 else None, v.min(), *np.quantile(v, [0.25, 0.5, 0.75]), v.max()]
        assert [r[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == [None if w is None else pytest.approx(w, rel=1e-9, abs=1e-9) for w in want]


def test_binned_density_is_within_its_bound(spark, columns):
    draw = np.random.default_rng(5)
    columns = {k: columns[k] for k in ("normal", "ties", "hot", "sorted", "one")} | {"tail": draw.standard_cauchy(3000), "two": [1.0, 2.0], "same": [3.0] * 9}
    df = long_of(spark, columns).unionByName(spark.createDataFrame([("none", None), ("two", None)], "feature string, value double"))
    exact = {(r["feature"], r["point"]): r for r in C.density(df, "feature", "value", 20).collect()}
    for tolerance in (1e-2, 1e-4):
        got = {(r["feature"], r["point"]): r for r in C.binned_density(df, "feature", "value", 20, tolerance).collect()}
        assert got.keys() == exact.keys() and {k for k, _ in got} == {"normal", "ties", "hot", "sorted", "tail", "two"}
        for (k, i), r in got.items():
            h = np.std(columns[k], ddof=1) * len(columns[k]) ** -0.2
            assert abs(r["density"] - exact[k, i]["density"]) <= 1.001 * tolerance / (h * np.sqrt(2 * np.pi))
            assert r["x"] == pytest.approx(exact[k, i]["x"])
