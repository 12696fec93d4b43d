"""Token arrays answered from word tables, against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from commentscope.functions import features as X
from commentscope.functions.lexicons import CATEGORY_WORDS, LEMMA_EXCEPTIONS, LEMMA_VOCABULARY, STOP_WORDS, VALENCE
from commentscope.operators import lookups as J
from commentscope.operators import vectors as V
from commentscope.operators.table_features import add_features_from_tables
from commentscope.plans import dictionaries as D


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(50)] + ["é", "", "a b"]
    out = [(i, f"s{i % 3}", [draw.choice(words) for _ in range(draw.randint(0, 25))], [draw.choice(words) for _ in range(draw.randint(0, 4))], [1.5, None]) for i in range(90)]
    return out + [(90, None, None, None, None), (90, None, None, ["w1"], None), (None, "x", [], [], []), (92, "hot", ["w7"] * 400, ["w7", None, "w8"], [2.0]), out[3], out[3]]


SCHEMA = "id long, batch string, a array<string>, b array<string>, rows array<double>"


@pytest.mark.parametrize("batch", [1, 60, D.BATCH])
def test_replaced_keeps_order_repeats_and_other_columns(spark, rows, batch):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    table = spark.createDataFrame([(f"w{i}", f"<{i}>") for i in range(0, 50, 2)] + [("not there", "x")], "word string, to string")
    got = Counter(map(str, D.replaced(df, "a", table, F.coalesce("to", "word"), batch).collect()))
    to = {f"w{i}": f"<{i}>" for i in range(0, 50, 2)}
    want = spark.createDataFrame([(i, s, [to.get(w, w) for w in a or []], b, r) for i, s, a, b, r in rows], SCHEMA).collect()
    assert got == Counter(map(str, want))


@pytest.mark.parametrize("batch", [1, 60, D.BATCH])
def test_word_sums_of_several_tables(spark, rows, batch):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    first = spark.createDataFrame([(f"w{i}", i / 4) for i in range(20)] + [("w3", 10.0), ("w4", None), ("", 2.0)], "word string, value double")
    second = spark.createDataFrame([("w7", 1), ("é", 1)], "word string, value int")
    got = D.word_sums(df, {"x": ("a", first), "y": ("b", second), "z": ("a", second)}, batch)
    assert got.columns == ["id", "batch", "rows", "x", "y", "z"]
    one = {f"w{i}": i / 4 for i in range(20)} | {"w3": 10.75, "": 2.0}
    one["w4"] = 1.0
    two = {"w7": 1, "é": 1}
    total = lambda t, ws: sum(t.get(w, 0) for w in ws or [] if w is not None)
    want = Counter((i, s, str(r), total(one, a), total(two, b), total(two, a)) for i, s, a, b, r in rows)
    assert Counter((r["id"], r["batch"], str(r["rows"]), r["x"], r["y"], r["z"]) for r in got.collect()) == want


def test_empty_tables(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "word string, value double")
    assert all(r["x"] == 0 for r in D.word_sums(df, {"x": ("a", none)}).collect())
    assert D.word_sums(df.limit(0), {"x": ("a", none)}).count() == 0
    assert D.replaced(df.limit(0), "a", none, F.col("word")).count() == 0


def test_lemmas_of_a_corpus_without_a_row_per_token(spark):
    df = spark.createDataFrame([(1, ["cats", "cat", "mice", "cats"]), (2, ["buses", "xs"]), (3, None), (4, ["bus"])], "id long, w array<string>").repartition(3)
    exceptions = spark.createDataFrame([("mice", "mouse")], "word string, lemma string")
    out = J.lemmatize_corpus(df, "w", exceptions)
    assert {r["id"]: r["w"] for r in out.collect()} == {1: ["cat", "cat", "mouse", "cat"], 2: ["bus", "xs"], 3: [], 4: ["bus"]}
    given = J.lemmatize_corpus(df, "w", exceptions, spark.createDataFrame([("x",)], "word string"))
    assert {r["id"]: r["w"] for r in given.collect()}[2] == ["buses", "x"]


def test_features_from_tables_equal_those_from_lists(spark):
    texts = ["You idiots are the worst, WORST people!! I hate you all.", "A lovely day; thanks for the good help and the goods.", "", None, "!!!",
             "Stupid stupid idiot kills morons and the women's mice", "kill KILL die", "the the the of"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, comment_text string, source string").repartition(3)
    keep = ["min_length", "num_words_vs_length", "num_stop_words", "stop_words_vs_words", "sentiment", "verbs_vs_length", "num_uppercase"]
    keep += [n for c in X.CATEGORIES for n in (f"bad_{c}_vs_length", f"num_bad_{c}", f"bad_{c}_vs_words")]
    words = lambda ws: spark.createDataFrame([(w,) for w in [*ws, *list(ws)[:2]]], "word string")
    bad = spark.createDataFrame([(w, c) for c, ws in CATEGORY_WORDS.items() for w in ws] + [("idiot", "other")], "word string, category string")
    valences = spark.createDataFrame(list(VALENCE.items()), "word string, value double")
    exceptions = spark.createDataFrame(list(LEMMA_EXCEPTIONS.items()), "word string, lemma string")
    got = add_features_from_tables(df, keep, X.CATEGORIES, words(STOP_WORDS), bad, valences, exceptions=exceptions, vocabulary=words(LEMMA_VOCABULARY), batch=9)
    want = X.add_features(df, keep, CATEGORY_WORDS)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    a, b = ({r["id"]: r.asDict() for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys()
    for i in a:
        assert all(a[i][k] == pytest.approx(b[i][k]) if isinstance(a[i][k], float) else a[i][k] == b[i][k] for k in a[i])
    assert sum(a[0][f"num_bad_{c}"] for c in X.CATEGORIES) > 0
    few = add_features_from_tables(df, ["num_words", "min_length"], [])
    assert few.count() == len(texts)


def test_document_vectors_average_by_number(spark):
    """The rows of a key are pooled; a text without tokens counts as one token of zeros."""
    rows = [(1, ["a", "b", "a", "?"]), (2, []), (3, None), (4, ["b"]), (4, ["a", "a"]), (None, ["a"]), (5, ["a"]), (5, [])]
    df = spark.createDataFrame(rows, "id long, t array<string>").repartition(3)
    vectors = spark.createDataFrame([("a", [1.0, 2.0, 9.0]), ("b", [4.0, 0.0, 9.0])], "word string, vec array<double>")
    out = V.document_vectors(df, "id", "t", vectors, 2)
    assert "MapInArrow" in out._jdf.queryExecution().executedPlan().toString()  # no row per document and word
    got = {r["id"]: r["vec"] for r in out.collect()}
    want = {1: [1.5, 1.0], 2: [0, 0], 3: [0, 0], 4: [2.0, 4 / 3], None: [1, 2], 5: [0.5, 1.0]}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    drawn = {r["id"]: r["vec"] for r in V.document_vectors(df.where("id = 1"), "id", "t", vectors, 2, True, 7).collect()}[1]
    own = df.select(V.uniform_from(F.lit("?"), F.lit(0), F.lit(7)), V.uniform_from(F.lit("?"), F.lit(1), F.lit(7))).first()
    assert drawn == pytest.approx([(6 + own[0]) / 4, (4 + own[1]) / 4])
