"""Operators against brute force and properties on small tables."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from commentscope.functions import features as X
from commentscope.functions import tokens as K
from commentscope.operators import corpus as C
from commentscope.operators.tfidf import term_tfidf
from commentscope.operators import labels as L
from commentscope.operators import learners as B
from commentscope.operators import lookups as J
from commentscope.operators import metrics as M
from commentscope.operators import reports as R
from commentscope.operators import sampling as A
from commentscope.operators import selection as Z
from commentscope.operators import sequences as Q
from commentscope.operators import vectors as V
from commentscope.plans.ordering import row_numbers, running_totals
from commentscope.plans.quantiles import exact_quantiles, quantiles
from commentscope.sources import tables as IO


def test_unscored_rows(spark):
    df = spark.createDataFrame([(1, 0), (-1, -1), (0, -1)], "a int, b int")
    assert [tuple(r) for r in L.drop_unscored(df, ["a", "b"]).collect()] == [(1, 0)]


def test_row_numbers_match_sorting(spark):
    ids = [f"k{i:05d}" for i in random.Random(1).sample(range(10 ** 5 - 1), 997)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    got = {r["id"]: r["rn"] for r in row_numbers(df, ["id"]).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(ids))}


def test_running_totals_per_group_with_a_hot_group(spark):
    rows = [("hot", i, i % 5) for i in range(600)] + [("b", i, 1) for i in range(7)] + [("c", 3, 9)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(5)
    got = running_totals(df, ["o"], {"t": F.col("v")}, within=["g"]).toPandas()
    want = pd.DataFrame(rows, columns=["g", "o", "v"]).sort_values(["g", "o"])
    want["t"] = want.groupby("g").v.cumsum()
    both = got.merge(want, on=["g", "o"])
    assert len(both) == len(rows) and (both.t_x == both.t_y).all()


def test_exact_quantiles_with_a_hot_value(spark):
    values = [0.0] * 300 + [float(x) for x in np.random.default_rng(2).normal(size=601)]
    df = spark.createDataFrame([("f", v) for v in values] + [("one", 5.0), ("f", None)], "feature string, value double")
    got = {r["feature"]: r for r in exact_quantiles(df, [0.0, 0.1, 0.5, 0.77, 1.0]).collect()}
    want = np.quantile(values, [0.0, 0.1, 0.5, 0.77, 1.0])
    assert np.allclose([got["f"][f"q{i}"] for i in range(5)], want) and got["f"]["n"] == 901
    assert got["one"]["q2"] == 5.0


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10001).select(F.lit("f").alias("feature"), F.col("id").cast("double").alias("value"))
    r = quantiles(df, [0.25, 0.5], exact=False).first()
    assert r["n"] == 10001 and abs(r["q0"] - 2500) < 20 and abs(r["q1"] - 5000) < 20


def test_failed_scorer_rows_are_left_out_for_both(spark):
    rows = [(m, i, l, 1, 0.0 if (m == "a" and i < 2) else 0.7) for m in "ab" for i in range(5) for l in "xy"]
    df = spark.createDataFrame(rows, "model string, id long, label string, y int, prob double").withColumn(
        "pred", (F.col("prob") >= 0.5).cast("int"))
    got = {(r["model"], r["rows"]): r["accuracy"] for r in R.compare_scorers(df, "id").collect()}
    assert got == {("a", "all"): 0.6, ("a", "scored"): 1.0, ("b", "all"): 1.0, ("b", "scored"): 1.0}


def test_contiguous_folds(spark):
    df = spark.range(12).withColumnRenamed("id", "k").repartition(3)
    folds = {r["k"]: r["fold"] for r in A.kfold_contiguous(df, "k", 5).collect()}
    assert [folds[i] for i in range(12)] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4]
    few = {r["k"]: r["fold"] for r in A.kfold_contiguous(spark.range(3).withColumnRenamed("id", "k"), "k", 5).collect()}
    assert few == {0: 0, 1: 1, 2: 2}


def test_shuffled_folds_and_tail(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in A.kfold_shuffled(df, "k", 5, 3).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 1000 and max(sizes) - min(sizes) < 120
    tail = [r["k"] for r in A.tail_split(df, "k", 0.1).where("is_validation = 1").collect()]
    assert sorted(tail) == list(range(900, 1000))


def test_oversampling(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)] + [(10, 1), (11, 1)], "id long, y int")
    out = A.random_oversample(df, "id", "y", 0.5).toPandas()
    assert len(out) == 15 and (out["copy"] == 0).sum() == 12
    counts = out.groupby("id").size()
    assert counts[10] == 3 and counts[11] == 2 and (counts[:10] == 1).all()
    assert A.random_oversample(df, "id", "y", 0.1).count() == 12


def test_oversampling_in_turn_keeps_keys_unique(spark):
    rng = random.Random(4)
    rows = [(i, int(rng.random() < 0.1), int(rng.random() < 0.2)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a int, b int")
    out = A.random_oversample(A.random_oversample(df, "id", "a"), "id", "b").toPandas()
    assert not out.duplicated(["id", "copy"]).any()
    assert len(out[out["copy"] == 0]) == 300
    assert abs((out.b == 1).sum() - 0.5 * (out.b == 0).sum()) <= 1


def test_leak_free_folds(spark):
    df = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(90)], "id long, y int")
    train, test = A.leak_free_fold(df, "id", "y", A.kfold_contiguous(df, "id", 5), 2)
    assert train.select("id").intersect(test.select("id")).count() == 0
    assert test.count() == 18


def test_auc_with_ties_and_single_class(spark):
    rows = [(i, "l", y, int(p >= 0.5), p) for i, (y, p) in enumerate([(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.8)])]
    rows += [(i, "none", 0, 0, 0.3) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, label string, y int, pred int, prob double")
    got = {r["label"]: r["auc"] for r in M.roc_auc(df).collect()}
    assert got["l"] == pytest.approx(0.875) and got["none"] is None
    w = M.roc_auc_weighted(M.roc_auc(df)).first()
    assert w["roc_auc_weighted"] == pytest.approx(0.875) and w["labels_without_auc"] == 1


def test_auc_properties(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 1), round(rng.random(), 2)) for i in range(400)]
    pos = [p for _, y, p in rows if y]
    neg = [p for _, y, p in rows if not y]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "id long, y int, prob double").selectExpr("id", "'l' label", "y", "0 pred", "prob")
    auc = lambda d: M.roc_auc(d).first()["auc"]
    assert auc(df) == pytest.approx(brute)
    assert auc(df.withColumn("prob", F.exp("prob"))) == pytest.approx(brute)
    assert auc(df.withColumn("prob", -F.col("prob"))) == pytest.approx(1 - brute)


def test_log_loss_and_undefined_precision(spark):
    rows = [(1, "a", 1, 1, 0.9), (1, "b", 1, 1, 0.6), (2, "a", 0, 0, 0.2), (2, "b", 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "id long, label string, y int, pred int, prob double")
    assert M.log_loss_multilabel(df, "id").first()["log_loss"] == pytest.approx(1.427116 / 2, abs=1e-6)
    none = df.withColumn("pred", F.lit(0))
    for r in M.precision_recall_f1(M.confusion(none)).collect():
        assert r["precision"] == 0 and r["f1"] == 0


# Published confusion matrices with the printed accuracy, precision, recall and F1.
@pytest.mark.parametrize("cells, want", [
    ((141973, 2304, 3195, 12099), (0.965539, 0.840033, 0.791095, 0.814830)),
    ((159093, 0, 478, 0), (0.9970, 0.0, 0.0, 0.0)),
    ((159003, 90, 182, 296), (0.9983, 0.7668, 0.6192, 0.6852))])
def test_scores_of_published_matrices(spark, cells, want):
    df = spark.createDataFrame([("l", *cells)], "label string, tn long, fp long, fn long, tp long")
    r = M.precision_recall_f1(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == pytest.approx(want, abs=1e-4)


def test_evaluate_equals_its_parts(spark):
    rng = random.Random(6)
    rows = [(i, l, rng.randint(0, 1), round(rng.random(), 1)) for i in range(100) for l in "ab"]
    df = spark.createDataFrame(rows, "id long, label string, y int, prob double").withColumn(
        "pred", (F.col("prob") >= 0.5).cast("int"))
    ev = M.evaluate(df, "id").first()
    assert ev["accuracy"] == pytest.approx(M.subset_accuracy(df, "id").first()["accuracy"])
    assert ev["log_loss"] == pytest.approx(M.log_loss_multilabel(df, "id").first()["log_loss"])
    pdf = df.toPandas()
    ok = pdf.assign(ok=pdf.y == pdf.pred).groupby("id").ok.all().mean()
    assert ev["accuracy"] == pytest.approx(ok)


def test_ensemble_of_the_boundary(spark):
    rows = [(1, "l", m, 1, p) for m, p in (("a", 0.4), ("b", 0.6), ("c", 0.5))]
    df = spark.createDataFrame(rows, "id long, label string, model string, y int, prob double")
    r = R.weighted_ensemble(df, "id", {"a": 0.25, "b": 0.25, "c": 0.5}).first()
    assert r["prob"] == pytest.approx(0.5) and r["pred"] == 1
    same = R.weighted_ensemble(df.withColumn("prob", F.lit(0.3)), "id", {"a": 0.25, "b": 0.25, "c": 0.5}).first()
    assert same["prob"] == pytest.approx(0.3)


def test_best_and_second(spark):
    df = spark.createDataFrame([("a", 0.9, 0.3), ("b", 0.9, 0.1), ("c", 0.8, 0.2), ("d", 0.7, None)],
                               "model string, accuracy double, log_loss double")
    got = {(r["metric"], r["place"], r["model"]) for r in R.best_and_second(df, ["accuracy", "log_loss"]).collect()}
    assert got == {("accuracy", 1, "a"), ("accuracy", 1, "b"), ("accuracy", 2, "c"),
                   ("log_loss", 1, "b"), ("log_loss", 2, "c")}


def test_tfidf_of_two_documents(spark):
    df = spark.createDataFrame([(1, ["aa", "bb", "cc"]), (2, ["aa", "bb"]), (3, [])], "id long, w array<string>")
    got = {r["term"]: r for r in term_tfidf(df.where("id < 3"), K.ngrams(F.col("w"), 2)).collect()}
    assert got["bb cc"]["idf"] == pytest.approx(1.405465, abs=1e-6)
    assert got["aa bb"]["score"] == pytest.approx(1.579739, abs=1e-6)
    assert got["bb cc"]["score"] == pytest.approx(0.814802, abs=1e-6)


def test_sentiment_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (-0.06, -0.05, 0.0, 0.05, 0.06)], "c double")
    r = C.sentiment_buckets(df, "c").first()
    assert (r["negative"], r["positive"], r["neutral"], r["remainder"]) == (1, 1, 1, 2)


def test_histogram_matches_numpy(spark):
    xs = [float(x) for x in np.random.default_rng(8).normal(size=300)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for rng in (None, (-1.0, 1.0)):
        want, _ = np.histogram(xs, bins=10, range=rng)
        got = C.histogram(df, "x", 10, *(rng or (None, None))).orderBy("bin").collect()
        assert [r["n"] for r in got] == want.tolist()


def test_document_vectors(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0])], "word string, vec array<double>")
    df = spark.createDataFrame([(1, ["a", "a", "z"]), (2, [])], "id long, w array<string>")
    got = {r["id"]: r["vec"] for r in V.document_vectors(df, "id", "w", vectors, 2).collect()}
    assert got[1] == pytest.approx([2 / 3, 0.0]) and got[2] == [0.0, 0.0]
    filled = [V.document_vectors(df, "id", "w", vectors, 2, True, 5).orderBy("id").collect() for _ in range(2)]
    assert filled[0] == filled[1] and 0 <= filled[0][0]["vec"][1] < 1 / 3 and filled[0][1]["vec"] == [0.0, 0.0]


def test_embedding_matrix_fills_like_the_known_entries(spark):
    vectors = spark.createDataFrame([(f"k{i}", [float(i % 7), 1.0]) for i in range(50)], "word string, vec array<double>")
    vocab = spark.createDataFrame([(f"u{i}", i) for i in range(2000)] + [("k3", 9999)], "word string, idx long")
    rows = {r["word"]: r["vec"] for r in V.embedding_matrix(vocab, vectors, 2).collect()}
    assert rows["k3"] == [3.0, 1.0] and len(rows) == 2001
    drawn = np.array([v for w, v in rows.items() if w != "k3"]).ravel()
    known = np.array([[float(i % 7), 1.0] for i in range(50)]).ravel()
    assert abs(drawn.mean() - known.mean()) < 0.15 and abs(drawn.std() - known.std()) < 0.15


def test_encode_blocks_keeps_every_row(spark):
    df = spark.createDataFrame([(i, "a b b" if i % 2 else None) for i in range(25)], "id long, t string")
    rows = V.encode_blocks(df, "id", "t", lambda texts: [[len(t), t.count("b")] for t in texts], 2).collect()
    assert {r["id"]: r["vec"] for r in rows} == {i: [5.0, 2.0] if i % 2 else [0.0, 0.0] for i in range(25)}


@pytest.mark.parametrize("budget", [1, 30, 1 << 18])
def test_encode_batches_pads_within_a_budget(spark, budget):
    draw = random.Random(3)
    texts = [[draw.randrange(5) for _ in range(draw.choice([0, 1, 2, 3, 9, 40]))] for _ in range(80)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, ids array<int>").repartition(3)

    def encode(ids, mask):
        assert ids.shape == mask.shape and (ids.size <= budget or len(ids) == 1) and (ids[~mask] == 0).all()
        return np.c_[np.where(mask, ids, 0).sum(axis=1), mask.sum(axis=1), np.full(len(ids), ids.shape[1])]

    got = {r["id"]: r["vec"] for r in V.encode_batches(df, "id", "ids", encode, budget).collect()}
    assert {i: v[:2] for i, v in got.items()} == {i: [sum(t or []), len(t or [])] for i, t in enumerate(texts)}
    if budget == 1 << 18:  # one matrix per batch is as wide as its longest text
        assert max(v[2] for v in got.values()) == 40


def test_bag_of_positions(spark):
    df = spark.createDataFrame([(1, ["a", "b", "b"]), (2, [])], "id long, w array<string>")
    ids = df.select("id", V.hashed_positions(F.col("w"), 4).alias("ids"))
    at = {r["id"]: r["ids"] for r in ids.collect()}
    import hashlib
    assert at[1] == [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 4 for w in "abb"]
    vec = {r["id"]: r["vec"] for r in V.encode_batches(ids, "id", "ids", V.bag_of_positions(4)).collect()}
    want = np.bincount(at[1], minlength=4)
    assert vec[1] == pytest.approx(list(want / np.linalg.norm(want))) and vec[2] == [0.0] * 4


def test_binned_area_is_within_its_bound(spark):
    draw = np.random.default_rng(6)
    rows = [(l, int(y), float(p)) for l in ("a", "b") for y, p in zip(draw.random(500) < 0.3, np.clip(draw.normal(0.5, 0.2, 500), 0, 1))]
    rows += [("one", 1, 0.5), ("one", 1, 1.0)]
    df = spark.createDataFrame(rows, "label string, y int, prob double").withColumn("pred", (F.col("prob") > 0.5).cast("int"))
    exact = {r["label"]: r["auc"] for r in M.roc_auc(df).collect()}
    for bins in (1, 7, 1000):
        got = {r["label"]: r for r in M.binned_roc_auc(df, None, bins).collect()}
        assert got.keys() == exact.keys() and got["one"]["auc"] is None and got["one"]["error_bound"] is None
        assert all(abs(got[l]["auc"] - exact[l]) <= got[l]["error_bound"] + 1e-12 for l in "ab")
    assert got["a"]["error_bound"] < 0.01


def test_model_table_of_labelled_and_unlabelled_rows(spark):
    draw = np.random.default_rng(7)
    rows = [(i, float(i), float(i % 3), [float(i % 2) + 0.1 * float(x), float(x), None]) for i, x in enumerate(draw.normal(size=60))]
    df = spark.createDataFrame(rows, "id long, f double, g double, v array<double>").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(0, 40)], "id long, y int, other int")
    table, kept = Z.model_table(df, labels, "id", ["y"], ["g", "f"], ["f"], "v", 3, 0.5)
    assert kept == ["d0"] and table.columns == ["id", "labelled", "y", "other", "g", "f_scaled", "d0"]
    got = {r["id"]: r for r in table.collect()}
    assert len(got) == 60 and sum(r["labelled"] for r in got.values()) == 40
    assert got[39]["f_scaled"] == 1.0 and got[59]["f_scaled"] == pytest.approx(59 / 39) and got[59]["y"] is None
    assert all(got[i]["d0"] == pytest.approx(rows[i][3][0], abs=1e-6) for i in got)


def test_sequences_and_padding(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "z"]), (2, ["q"]), (3, [])], "id long, w array<string>")
    vocab = Q.vocab_index(df, "w", 3)
    assert [(r["word"], r["idx"]) for r in vocab.orderBy("idx").collect()] == [("a", 1), ("b", 2)]
    got = {r["id"]: r["seq"] for r in Q.texts_to_sequences(df, "id", "w", vocab).collect()}
    assert got == {1: [1, 2, 1], 2: [], 3: []}
    pads = [spark.range(1).select(Q.pad_front(F.array(*[F.lit(x) for x in s]), 3).alias("x")).first()["x"]
            for s in ([1, 2, 3, 4, 5], [7, 8])]
    assert pads == [[3, 4, 5], [0, 7, 8]]


def test_constant_feature_has_null_correlation(spark):
    df = spark.createDataFrame([("c", 0.1, i % 2) for i in range(9)] + [("x", float(i), i % 2) for i in range(9)],
                               "feature string, value double, y int").repartition(4)
    got = {r["feature"]: r["r"] for r in Z.label_correlation(df, ["y"]).collect()}
    assert got["c"] is None and got["x"] == pytest.approx(np.corrcoef(range(9), [i % 2 for i in range(9)])[0, 1])


def test_minmax(spark):
    train = spark.createDataFrame([(2.0, 5.0), (4.0, 5.0), (6.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(8.0, 5.0)], "a double, b double")
    limits = Z.fit_minmax(train, ["a", "b"])
    assert [r["a_scaled"] for r in Z.apply_minmax(train, limits, ["a", "b"]).orderBy("a").collect()] == [0.0, 0.5, 1.0]
    r = Z.apply_minmax(test, limits, ["a", "b"]).first()
    assert (r["a_scaled"], r["b_scaled"]) == (1.5, 0.0)


def test_drop_collinear(spark):
    matrix = spark.createDataFrame([("a", "b", 0.95), ("b", "a", 0.95), ("a", "c", 0.1), ("c", "a", 0.1), ("b", "c", None)],
                                   "a string, b string, r double")
    strength = spark.createDataFrame([("a", 0.3), ("b", 0.5), ("c", 0.2)], "feature string, max_abs_r double")
    kept = {r["feature"]: r["kept"] for r in Z.drop_collinear(matrix, strength, 0.9).collect()}
    assert kept == {"b": True, "a": False, "c": True}


def test_join_forms_agree_with_inline_forms(spark):
    df = spark.createDataFrame([(1, ["cats", "the", "idiots", "idiots"]), (2, [])], "id long, w array<string>")
    from commentscope.functions.lexicons import LEMMA_EXCEPTIONS, NOUNS, TAG_LEXICON
    vocab = spark.createDataFrame([(n,) for n in NOUNS], "word string")
    ex = spark.createDataFrame(list(LEMMA_EXCEPTIONS.items()), "word string, lemma string")
    table = J.lemma_table(J.corpus_vocabulary(df, "w"), vocab, ex)
    got = {r["id"]: r["lemmatization"] for r in J.lemmatize_with_table(df, ["id"], "w", table).collect()}
    inline = {r["id"]: r["l"] for r in df.select("id", F.transform("w", lambda w: K.lemma(w)).alias("l")).collect()}
    assert got == inline == {1: ["cats", "the", "idiot", "idiot"], 2: []}
    lexicon = spark.createDataFrame([(w, t) for t, ws in TAG_LEXICON.items() for w in ws], "word string, tag string").dropDuplicates(["word"])
    tagged = {r["id"]: [t["tag"] for t in r["tagged"]] for r in J.tag_with_table(df, ["id"], "w", lexicon).collect()}
    assert tagged[1] == [r for r in df.where("id = 1").select(F.transform("w", lambda w: K.tag_word(w)).alias("t")).first()["t"]]


def test_csv_round_trip_with_line_ends_and_quotes(spark, tmp_path):
    rows = [("1", "a \"quoted\"\nline, two"), ("2", "back\\slash"), ("3", "x")]
    path = str(tmp_path / "t")
    IO.write_table(spark.createDataFrame(rows, "id string, comment_text string"), path, "csv")
    back = IO.read_table(spark, path, IO.TEXT_SCHEMA)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_word_vector_files(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("2 3\na 1 2 3\nb 4 5 6.5 \n")
    got = {r["word"]: r["vec"] for r in IO.read_word_vectors(spark, str(path), 3).collect()}
    assert got == {"a": [1.0, 2.0, 3.0], "b": [4.0, 5.0, 6.5]}


def test_density_integrates_to_one(spark):
    xs = [float(x) for x in np.random.default_rng(9).normal(size=200)]
    df = spark.createDataFrame([("k", x) for x in xs], "feature string, value double")
    got = C.density(df, "feature", "value", 200).orderBy("point").toPandas()
    assert math.isclose(np.trapezoid(got.density, got.x), 1.0, abs_tol=0.01)


def test_correlation_over_complete_pairs(spark):
    xs = [1.0, None, 2.0, 4.0, None, 7.0, 3.0]
    ys = [0, 1, 0, 1, 1, 1, None]
    df = spark.createDataFrame([("f", x, y) for x, y in zip(xs, ys)], "feature string, value double, l int")
    pairs = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None]
    want = np.corrcoef(*zip(*pairs))[0, 1]
    assert Z.label_correlation(df, ["l"]).first()["r"] == pytest.approx(want)


def test_plurals_of_category_words_count(spark):
    df = spark.createDataFrame([(1, "racists and bigots are idiots")], "id long, comment_text string")
    row = X.add_features(df, ["num_bad_identity_hate", "num_bad_toxic"]).first()
    assert (row["num_bad_identity_hate"], row["num_bad_toxic"]) == (2, 1)
    own = X.add_features(df, ["num_bad_x"], categories={"x": ["and", "racist"]}).first()
    assert own["num_bad_x"] == 1


def test_join_forms_of_stop_words_and_valences(spark):
    df = spark.createDataFrame([(1, ["the", "cat", "the", "hat"]), (2, []), (3, ["the"])], "id long, w array<string>")
    stop = spark.createDataFrame([("the",), ("hat",)], "word string")
    assert {r["id"]: r["words"] for r in J.words_not_in(df, ["id"], "w", stop).collect()} == {1: ["cat"], 2: [], 3: []}
    values = spark.createDataFrame([("the", 0.5), ("hat", -2.0)], "word string, value double")
    assert {r["id"]: r["total"] for r in J.word_sums(df, ["id"], "w", values).collect()} == {1: -1.0, 2: 0.0, 3: 0.5}


def test_csv_keeps_blanks_empty_texts_and_nulls(spark, tmp_path):
    texts = ["  lead and trail  ", "tab\tend\t", "", None, "a\r\nb", 'x "y", z', "\\", "   "]
    df = spark.createDataFrame(list(enumerate(texts)), "id string, comment_text string")
    IO.write_table(df, str(tmp_path / "c"), "csv")
    got = {r["id"]: r["comment_text"] for r in IO.read_table(spark, str(tmp_path / "c"), IO.TEXT_SCHEMA).collect()}
    assert got == {str(i): t for i, t in enumerate(texts)}


def test_word_list_lines_are_words(spark, tmp_path):
    (tmp_path / "w.txt").write_text('x,y\n"say ""so"""\n lead\n\nx,y\n')
    assert {r["word"] for r in IO.read_words(spark, str(tmp_path / "w.txt")).collect()} == {"x,y", 'say "so"', " lead"}


def test_word_vectors_with_blanks_and_rejected_lines(spark, tmp_path):
    (tmp_path / "v.txt").write_text("2 2\nnew york 1 2\nok 3 4\nbad 5 x\n")
    got = {r["word"]: r["vec"] for r in IO.read_word_vectors(spark, str(tmp_path / "v.txt"), 2).collect()}
    assert got == {"new york": [1.0, 2.0], "ok": [3.0, 4.0]}
    assert [r["value"] for r in IO.rejected_word_vectors(spark, str(tmp_path / "v.txt"), 2).collect()] == ["bad 5 x"]


def test_forests_deeper_than_the_engine_grows_are_refused():
    assert B.random_forest(10, 30).getMaxDepth() == 30
    with pytest.raises(ValueError, match="30"):
        B.random_forest(10, 100)
