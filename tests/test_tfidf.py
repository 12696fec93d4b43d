"""Packed tf-idf against a plain version."""

import math
import random
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from commentscope.operators.tfidf import term_frequencies, term_tfidf
from commentscope.session import ensure_checkpoint_dir


def plain(docs):
    n, df, score = len(docs), Counter(), defaultdict(float)
    tfs = [Counter(t for t in d or [] if t is not None) for d in docs]
    for tf in tfs:
        df.update(tf.keys())
    idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in df.items()}
    for tf in tfs:
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in tf.items()))
        for t, c in tf.items():
            score[t] += c * idf[t] / norm
    return {t: (df[t], idf[t], score[t]) for t in df}


def check(found, docs):
    want = plain(docs)
    got = {r["term"]: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t], rel=1e-9) for t in want)


@pytest.mark.parametrize("batch", [1, 40, 1 << 19])
def test_matches_plain_version(spark, batch):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(40)] + ["é", "", " ", "of the"]
    docs = [[draw.choice(words) for _ in range(draw.randint(0, 30))] for _ in range(120)]
    docs += [None, [], [None, "x", None], [None], ["the"] * 200, docs[0], docs[0]]
    df = spark.createDataFrame([(d,) for d in docs], "terms array<string>").repartition(5)
    check(term_tfidf(df, F.col("terms"), batch), docs)


def test_hot_term_and_empty_tables(spark):
    docs = [["hot", f"own{i}"] if i % 3 else ["hot"] for i in range(300)]
    df = spark.createDataFrame([(d,) for d in docs], "terms array<string>").repartition(7)
    check(term_tfidf(df, F.col("terms"), 16), docs)
    assert term_tfidf(df.limit(0), F.col("terms")).count() == 0
    assert term_tfidf(df.select(F.lit(None).cast("array<string>").alias("terms")), F.col("terms")).count() == 0


def test_no_row_per_term_is_shuffled(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 50, "terms array<string>").repartition(4)
    plan = term_tfidf(df, F.col("terms"))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan


@pytest.mark.parametrize("batch,size", [(1, 2), (40, 3), (1 << 19, 2), (1 << 19, 1)])
def test_terms_of_consecutive_words(spark, batch, size):
    draw = random.Random(2)
    docs = [[draw.choice(["a", "b", "é", "c"]) for _ in range(draw.randint(0, 12))] for _ in range(90)]
    docs += [None, [], ["a"], [None], ["a", None, "b", "c"], ["x"] * 50, docs[0]]
    grams = [[None if None in d[i:i + size] else " ".join(d[i:i + size]) for i in range(len(d) - size + 1)] for d in (d or [] for d in docs)]
    df = spark.createDataFrame([(d,) for d in docs], "words array<string>").repartition(5)
    check(term_tfidf(df, F.col("words"), batch, size), grams)
    found = {r["term"]: r["n"] for r in term_frequencies(df, F.col("words"), size, batch).collect()}
    assert found == Counter(g for d in grams for g in d if g is not None)


def test_frequencies_of_an_empty_table(spark):
    df = spark.createDataFrame([(["a"],), (None,)], "words array<string>")
    assert term_frequencies(df, F.col("words"), 2).count() == 0
    assert term_frequencies(df.limit(0), F.col("words"), 2).count() == 0


def test_terms_are_neither_kept_nor_sent_twice(spark):
    draw = random.Random(3)
    docs = [[f"word{draw.randint(0, 2000)}" for _ in range(500)] for _ in range(120)]
    df = spark.createDataFrame([(d,) for d in docs], "words array<string>").repartition(3)
    ensure_checkpoint_dir(spark)
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    held = {f: f.stat().st_size for f in folder.rglob("*") if f.is_file()}
    found = term_tfidf(df, F.col("words"), 1 << 14, 3)
    kept = sum(f.stat().st_size for f in folder.rglob("*") if f.is_file() and f not in held)
    assert kept < 8 * sum(map(len, docs))  # over 50 bytes a word when the terms were part of it
    check(found, [[" ".join(d[i:i + 3]) for i in range(len(d) - 2)] for d in docs])
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("batch", [1, 1 << 19])
def test_terms_are_equal_by_text(spark, batch):
    docs = [["a b", "c", "d"], ["a", "b c"], ["é", "", "c"], ["x" * 300, "b"], ["a b", "c"], ["", ""]]
    df = spark.createDataFrame([(d,) for d in docs], "words array<string>").repartition(2)
    check(term_tfidf(df, F.col("words"), batch, 2), [[" ".join(d[i:i + 2]) for i in range(len(d) - 1)] for d in docs])


def test_terms_longer_than_one_number_holds(spark):
    draw = random.Random(5)
    docs = [[f"w{draw.randint(0, 400)}" for _ in range(n)] * 2 for n in (3, 40, 300)]
    df = spark.createDataFrame([(d,) for d in docs], "words array<string>").repartition(2)
    check(term_tfidf(df, F.col("words"), size=9), [[" ".join(d[i:i + 9]) for i in range(len(d) - 8)] for d in docs])
