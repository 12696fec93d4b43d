"""Problem transforms, learners, tuning and persistence on a small separable table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from commentscope.operators import learners as B
from commentscope.operators import metrics as M
from commentscope.operators import multilabel as ML
from commentscope.operators import sampling as A

LABELS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(240, 3))
    data = [(i, float(r[0]), float(r[1]), float(r[2]), int(r[0] > 0.2), int(r[0] + r[1] > 0.8)) for i, r in enumerate(x)]
    df = spark.createDataFrame(data, "id long, x double, y double, z double, a int, b int")
    return A.kfold_shuffled(ML.assemble(df, ["x", "y", "z"]), "id", 3, 1).cache()


@pytest.mark.parametrize("name", list(ML.TRANSFORMS))
def test_transforms_learn_both_labels(rows, name):
    predict = ML.TRANSFORMS[name](rows, LABELS, B.logistic_regression(240))
    out = predict(rows)
    auc = {r["label"]: r["auc"] for r in M.roc_auc(M.score_rows(out, ["id"], LABELS)).collect()}
    assert auc["a"] > 0.95 and auc["b"] > 0.95
    assert set(out.columns) >= {"p_a", "p_b"} and not [c for c in out.columns if c.startswith("__y")]


@pytest.mark.parametrize("make", [lambda: B.random_forest(10, 4), B.gaussian_naive_bayes, lambda: B.gradient_boosting(5, 2),
                                  lambda: B.AdaBoost(rounds=6)], ids=["forest", "bayes", "boosting", "adaboost"])
def test_learners(rows, make):
    out = ML.fit_binary_relevance(rows, ["a"], make())(rows)
    assert M.roc_auc(M.score_rows(out, ["id"], ["a"])).first()["auc"] > 0.95


def test_adaboost_matches_a_direct_computation(spark):
    x = np.array([0.0, 1, 2, 3, 4, 5, 6, 7])
    y = np.array([0, 0, 1, 0, 1, 1, 0, 1])
    df = ML.assemble(spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int"), ["x"])
    model = B.AdaBoost(rounds=3, labelCol="y").fit(df)
    p = np.array([r["probability"][1] for r in model.transform(df).orderBy("x").collect()])

    w, total = np.ones(8), np.zeros(8)
    for _ in range(3):
        best = None
        for cut in (x[:-1] + x[1:]) / 2:
            left = x <= cut
            shares = [np.average(y[s], weights=w[s]) for s in (left, ~left)]
            gini = sum(w[s].sum() * 2 * q * (1 - q) for s, q in zip((left, ~left), shares))
            if best is None or gini < best[0] - 1e-12:
                best = (gini, left, shares)
        _, left, shares = best
        q = np.clip(np.where(left, shares[0], shares[1]), 2 ** -52, 1 - 2 ** -52)
        h = 0.5 * np.log(q / (1 - q))
        total += h
        w = w * np.exp(-np.where(y == 1, 1, -1) * h)
        w = w / w.sum()
    assert np.allclose(p, 1 / (1 + np.exp(-2 * total / 3)), atol=1e-6)


def test_powerset_with_a_two_class_learner(rows):
    out = ML.fit_label_powerset(rows, LABELS, B.gradient_boosting(3, 2), binary_only=True)(rows)
    r = out.agg(F.min("p_a").alias("lo"), F.max("p_a").alias("hi")).first()
    assert 0 <= r["lo"] < r["hi"] <= 1


def test_powerset_shares_sum_over_combinations(rows):
    predict = ML.fit_label_powerset(rows.where("a = 1"), LABELS, B.logistic_regression(100))
    assert predict(rows).where("abs(p_a - 1) > 1e-9").count() == 0


def test_grid_search_and_kfold(rows):
    best, table = ML.grid_search(rows, "a", B.logistic_regression(1), [{"regParam": 0.01}, {"regParam": 50.0}], "fold",
                                 "f1", folds=3)
    t = {r["point"]: r["mean"] for r in table.collect()}
    assert t["regParam=0.01"] > t["regParam=50.0"] and best.getRegParam() == 0.01
    ev = ML.kfold_evaluate(rows, "id", LABELS, lambda d: ML.fit_binary_relevance(d, LABELS, B.gaussian_naive_bayes()),
                           folds=3).collect()
    assert len(ev) == 3 and all(r["roc_auc_weighted"] > 0.9 for r in ev)


def test_saved_model_predicts_the_same(rows, tmp_path):
    model = ML.fit_one(B.logistic_regression(240), rows, "a")
    ML.save_model([model], str(tmp_path / "m"))
    a = ML.add_probability(model, rows, "a").orderBy("id").select("p_a").collect()
    b = ML.add_probability(ML.load_model(str(tmp_path / "m")), rows, "a").orderBy("id").select("p_a").collect()
    assert a == b


@pytest.mark.parametrize("fit", [ML.fit_binary_relevance, ML.fit_classifier_chain, ML.fit_label_powerset], ids=["relevance", "chain", "powerset"])
@pytest.mark.parametrize("make", [lambda: B.logistic_regression(100), B.gaussian_naive_bayes, lambda: B.random_forest(3, 2)], ids=["logistic", "bayes", "forest"])
def test_saved_transforms_predict_alike(rows, fit, make, tmp_path):
    model = fit(rows, ["a", "b"], make())
    model.save(str(tmp_path / "m"))
    again = ML.FittedTransform.load(str(tmp_path / "m"))
    pick = lambda m: {r["id"]: (r["p_a"], r["p_b"]) for r in m(rows).collect()}
    assert pick(model) == pick(again)


def test_saved_adaboost_predicts_alike(rows, tmp_path):
    model = ML.fit_binary_relevance(rows, ["a"], B.AdaBoost(rounds=3))
    model.save(str(tmp_path / "m"))
    pick = lambda m: {r["id"]: r["p_a"] for r in m(rows).collect()}
    assert pick(model) == pick(ML.FittedTransform.load(str(tmp_path / "m")))


def test_grid_over_a_transform_by_a_score_of_all_labels(rows):
    folds = A.kfold_shuffled(rows, "id", 3, 1)
    best, table = ML.grid_search_transform(folds, "id", ["a", "b"], ML.fit_classifier_chain, B.random_forest(5), [{"maxDepth": 1}, {"maxDepth": 4}], folds=3)
    got = {r["point"]: r["mean"] for r in table.collect()}
    assert set(got) == {"maxDepth=1", "maxDepth=4"} and best.models[0].getMaxDepth() == (1 if got["maxDepth=1"] >= got["maxDepth=4"] else 4)
    one = ML.kfold_score(folds, "id", ["a", "b"], lambda df: ML.fit_classifier_chain(df, ["a", "b"], B.random_forest(5, 4)), "f1_weighted", folds=3).first()
    assert one["mean"] == pytest.approx(got["maxDepth=4"]) and one["score"] == "f1_weighted"


def direct_boost(x, y, cuts, rounds, rate):
    """Margins after each round, by the definition, with the cuts the learner offers."""
    w, sign, total = np.full(len(y), 1 / len(y)), np.where(y == 1, 1, -1), np.zeros(len(y))
    for _ in range(rounds):
        best = (2 * w[y == 1].sum() * w[y == 0].sum() / w.sum(), None)
        for f, own in enumerate(cuts):
            for c in own:
                left = x[:, f] <= c
                gini = sum(2 * w[s & (y == 1)].sum() * w[s & (y == 0)].sum() / w[s].sum() for s in (left, ~left) if w[s].sum() > 0)
                if gini < best[0] * (1 - 1e-9):
                    best = (gini, left)
        left = best[1] if best[1] is not None else np.ones(len(y), bool)
        share = lambda s: np.clip(w[s & (y == 1)].sum() / w[s].sum(), 2 ** -52, 1 - 2 ** -52)
        q = np.where(left, share(left), share(~left) if (~left).any() else 0.5)
        h = 0.5 * np.log(q / (1 - q))
        total += h
        w = w * np.exp(-rate * sign * h)
        w /= w.sum()
    return total


@pytest.mark.parametrize("rounds, rate", [(1, 1.0), (40, 1.0), (25, 0.3)])
def test_adaboost_margins_on_several_features(spark, rounds, rate):
    from commentscope.operators import boosting

    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=(150, 2)), rng.integers(0, 3, 150), np.full(150, 7.0)]
    y = ((x[:, 0] + 0.5 * x[:, 1] + 0.4 * rng.normal(size=150)) > 0).astype(int)
    df = ML.assemble(spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "a double, b double, c double, d double, y int"), list("abcd")).repartition(3)
    model = B.AdaBoost(rounds=rounds, rate=rate, labelCol="y").fit(df)
    from pyspark.ml.functions import vector_to_array
    cuts = boosting.cuts(df.select(vector_to_array("features").alias("f")), "f", 4)
    assert [len(c) for c in cuts[2:]] == [2, 0] and max(map(len, cuts)) < boosting.BINS
    got = {(r["a"], r["b"]): r["rawPrediction"][1] for r in model.transform(df).collect()}
    want = direct_boost(x, y, cuts, rounds, rate)
    assert np.allclose([got[a, b] for a, b in x[:, :2]], want, atol=1e-6)


def test_adaboost_500_rounds_write_features_once(spark, monkeypatch):
    from commentscope.operators import boosting

    written = []
    keep = boosting.pinned
    monkeypatch.setattr(boosting, "pinned", lambda df: (written.append(df.columns), keep(df))[1])
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] ** 2 + x[:, 1] + 0.1 * rng.normal(size=400) > 1).astype(int)
    df = ML.assemble(spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)], "a double, b double, c double, y int").coalesce(1), list("abc"))
    model = B.AdaBoost(rounds=500, labelCol="y").fit(df)
    assert written == [["x", "y"]] and len(model.stumps) == 500
    out = model.transform(df)
    p = np.array([r["probability"][1] for r in out.collect()])
    assert np.isfinite(p).all() and ((p > 0.5) == y).mean() > 0.93


def test_adaboost_on_one_class_and_pure_cuts(spark):
    one = ML.assemble(spark.createDataFrame([(float(i), 1) for i in range(9)], "a double, y int"), ["a"])
    model = B.AdaBoost(rounds=4, labelCol="y").fit(one)
    assert all(s[0] == -1 for s in model.stumps) and {r["prediction"] for r in model.transform(one).collect()} == {1.0}
    pure = ML.assemble(spark.createDataFrame([(float(i), int(i > 4)) for i in range(9)], "a double, y int"), ["a"])
    model = B.AdaBoost(rounds=30, labelCol="y").fit(pure)
    assert [r["prediction"] for r in model.transform(pure).orderBy("a").collect()] == [0.0] * 5 + [1.0] * 4


def test_grid_over_transforms_fits_equal_points_once(rows, monkeypatch):
    fits = []
    for name in ML.TRANSFORMS:
        fit = ML.TRANSFORMS[name]
        monkeypatch.setitem(ML.TRANSFORMS, name, lambda df, labels, est, fit=fit, name=name: (fits.append(name), fit(df, labels, est))[1])
    folds = A.kfold_shuffled(rows, "id", 3, 1)
    grid = [{"transform": "classifier_chain"}, {"transform": "binary_relevance"}, {"transform": "classifier_chain"}]
    best, table = ML.grid_search_transform(folds, "id", LABELS, None, B.gaussian_naive_bayes(), grid, folds=3, parallelism=2)
    got = {r["point"]: (r["mean"], r["std"]) for r in table.collect()}
    assert sorted(fits[:-1]) == ["binary_relevance"] * 3 + ["classifier_chain"] * 3
    assert best.kind == max(("classifier_chain", "binary_relevance"), key=lambda n: got[f"transform={n}"][0])
    loss = ML.grid_search_transform(folds, "id", LABELS, None, B.gaussian_naive_bayes(), grid[:2], "log_loss", folds=3)
    means = {r["point"]: r["mean"] for r in loss[1].collect()}
    assert loss[0].kind == min(("classifier_chain", "binary_relevance"), key=lambda n: means[f"transform={n}"])
