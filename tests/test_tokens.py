"""The scanned token patterns and the guarded word rules against the plain ones."""

import random

from pyspark.sql import functions as F

from commentscope.functions import predicates as P
from commentscope.functions import text as T
from commentscope.functions import tokens as K


def test_scanned_tokens_are_those_of_the_alternatives(spark):
    assert r"\s" not in K.ascii_form("|".join(K.ALTERNATIVES)) and r"\s" not in K.PLAIN_TOKEN
    draw = random.Random(5)
    marks = [*"abcZ09_'-.@#:;=<>3()[]{}|\\/!?,+*&%$\"`~^ \t\n\r\x0b\x0c\x1c\x1f\x7f", "http://", "https://", "www.", "ab", "abc", "don't"]
    for own, ascii_only in ((marks, True), ([*marks, "é", "中", "\x85", " ", "²"], False)):
        rows = [("".join(draw.choice(own) for _ in range(draw.randint(0, 50))),) for _ in range(3000)]
        df = spark.createDataFrame(rows, "x string")
        no_mail = F.regexp_extract_all("x", F.lit("|".join(a for a in K.ALTERNATIVES if a != K.MAIL_TOKEN)), F.lit(0))
        want = F.when(F.contains("x", F.lit("@")), F.regexp_extract_all("x", F.lit(K.TOKEN), F.lit(0))).otherwise(no_mail)
        assert df.where(~K.words(F.col("x"), ascii_only).eqNullSafe(want)).count() == 0
        assert df.where(T.strip_punctuation(F.col("x")) != F.translate("x", T.PUNCTUATION, "")).count() == 0


def test_words_that_start_with_a_letter_skip_the_searches(spark):
    words = ["", "a", "zebras", "{", "`", "!", "\"#", "A", "Zs", "9", "9s", "é", "running", "_", "~", "a!", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", P.is_punctuation(F.col("w")).alias("p"), K.tag_word(F.col("w"), {"DT": ["a"]}).alias("t"), K.lemma(F.col("w"), {"feet": "foot"}, ["zebra"]).alias("l")).collect()
    for w, p, t, lemma in rows:
        assert p == (None if w is None else w in T.PUNCTUATION)
        assert lemma == ("zebra" if w == "zebras" else w)
    assert [r["t"] for r in rows[:-1]] == [".", "DT", "NNS", ".", ".", ".", ".", "NN", "NNS", "CD", "CD", "NN", "VBG", ".", ".", "NN"]
