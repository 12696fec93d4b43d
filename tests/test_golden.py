"""Hand-computed values for the golden comments and the small operator cases."""

import pytest
from pyspark.sql import functions as F

from commentscope.catalog.golden import GOLDEN
from commentscope.functions import features as X
from commentscope.functions import predicates as P
from commentscope.functions import text as T
from commentscope.functions import tokens as K

# id -> noise_removed_text, clean_text
CLEANED = {
    -1: ("Hello world", "hello world"),
    -2: ("", ""),
    -3: (" ", " "),
    -4: ("STOP!!! Why?? (really...)", "stop! why? (really."),
    -5: ("it is here: see and now", "it is here: see and now"),
    -6: ("Caf d j vu ok", "caf d j vu ok"),
    -7: ("mail me at a.b@c.example from 10.0.0.1", "mail me at a.b@c.example from 10.0.0.1"),
    -8: (" 12:30, 5 March 2010 and 12 ao t 2020", " 12:30, 5 march 2010 and 12 ao t 2020"),
    -11: ("say \"\"quoted\"\" \\\\ [[link]] --> end", "say \"\"quoted\"\" \\\\ [link] - end"),
    -12: ("line1 line2 line3\ttab", "line1 line2 line3\ttab"),
    -13: ("do not SHOUT at ME you are loud", "do not shout at me you are loud"),
}
# id -> len, !, ?, punct, once, repeated, upper, dd:dd, date_long, date_short, ip, http, mail
COUNTS = {
    -1: (11, 0, 0, 0, 2, 0, 1, 0, 0, 0, 0, 0, 0),
    -2: (0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    -3: (3, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    -4: (25, 3, 2, 10, 3, 0, 5, 0, 0, 0, 0, 0, 0),
    -5: (61, 0, 0, 1, 7, 1, 0, 0, 0, 0, 0, 1, 0),
    -6: (18, 0, 0, 0, 4, 0, 1, 0, 0, 0, 0, 0, 0),
    -7: (38, 0, 0, 6, 6, 0, 0, 0, 0, 0, 1, 0, 1),
    -8: (37, 0, 0, 2, 6, 1, 1, 1, 1, 2, 0, 0, 0),
    -9: (9, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0),
    -10: (29, 0, 0, 0, 1, 2, 0, 0, 0, 0, 0, 0, 0),
    -11: (34, 0, 0, 13, 4, 0, 0, 0, 0, 0, 0, 0, 0),
    -12: (22, 0, 0, 0, 4, 0, 0, 0, 0, 0, 0, 0, 0),
    -13: (29, 0, 0, 0, 7, 0, 7, 0, 0, 0, 0, 0, 0),
    -14: (1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0),
}
COUNT_NAMES = ["text_length", "num_exclamation_marks", "num_question_marks", "num_punctuations", "num_unique_words",
               "num_repeated_words", "num_uppercase", "num_timestamp", "num_date_long", "num_date_short", "num_ip",
               "num_http", "num_mail"]


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(GOLDEN, "doc_id long, comment_text string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_cleaned_texts(golden):
    rows = {r["doc_id"]: (r["noise_removed_text"], r["clean_text"]) for r in T.clean_comments(golden).collect()}
    for key, want in CLEANED.items():
        assert rows[key] == want, key


def test_counts(golden):
    for r in X.add_features(golden, COUNT_NAMES).collect():
        if r["doc_id"] in COUNTS:
            assert tuple(r[c] for c in COUNT_NAMES) == COUNTS[r["doc_id"]], r["doc_id"]


def test_all_features_named_and_finite(golden):
    df = X.add_features(golden)
    assert df.columns == ["doc_id", *X.feature_names()] and len(X.feature_names()) == 68
    for r in df.collect():
        assert all(v is not None for v in r)


def test_null_comment_is_kept(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, comment_text string")
    r = X.add_features(df, ["text_length", "num_words", "readability", "sentiment"]).first()
    assert tuple(r) == (1, 0, 0, 0.0, 0.0)


def test_cleaning_twice_changes_nothing(golden):
    once = T.clean_comments(golden).select("doc_id", F.col("clean_text").alias("comment_text"))
    twice = T.clean_comments(once)
    assert twice.where("clean_text <> comment_text").count() == 0


def test_symbols_on_raw_text(spark):
    assert one(spark, T.blank_symbols(F.lit("ok 😀😀 ✂ 漢字 end"))) == "ok       end"


@pytest.mark.parametrize("text, want", [
    ("CAN'T stop 'won't' o'neil's", "cannot stop 'will not' o'neil's"),
    ("no mark", "no mark"), ("it's it's", "it is it is"), ("'", "'"), ("x' 'y", "x' 'y")])
def test_contractions(spark, text, want):
    assert one(spark, T.expand_contractions(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [
    ("see https://a.b/c me@x.org @you #tag :) <3 3.14 rock-n-roll don't ... !",
     ["see", "https://a.b/c", "me@x.org", "@you", "#tag", ":)", "<3", "3.14", "rock-n-roll", "don't", "...", "!"]),
    ("", []), ("a_b é1", ["a_b", "é1"])])
def test_tokens(spark, text, want):
    assert one(spark, K.words(F.lit(text))) == want


def test_short_forms_of_the_token_pattern_agree(golden):
    cleaned = T.clean_comments(golden)
    c = F.col("clean_text")
    assert cleaned.where(K.words(c) != K.words(c, ascii_only=True)).count() == 0
    bare = T.strip_punctuation(c)
    assert cleaned.where(K.words(bare) != K.words_no_punctuation(c)).count() == 0


def test_tags_and_lemmas(spark):
    tags = {w: one(spark, K.tag_word(F.lit(w))) for w in
            ["the", "quickly", "going", "walked", "cats", "42", "!", "house", "is"]}
    assert tags == {"the": "DT", "quickly": "RB", "going": "VBG", "walked": "VBD", "cats": "NNS", "42": "CD",
                    "!": ".", "house": "NN", "is": "VBZ"}
    lemmas = {w: one(spark, K.lemma(F.lit(w))) for w in ["idiots", "stories", "churches", "women", "mice", "xyzs", "wolves"]}
    assert lemmas == {"idiots": "idiot", "stories": "story", "churches": "church", "women": "woman", "mice": "mouse",
                      "xyzs": "xyzs", "wolves": "wolf"}


def test_punctuation_is_a_substring_test(spark):
    got = [one(spark, P.is_punctuation(F.lit(w))) for w in ["!\"", "()", "...", "!", "a", ""]]
    assert got == [True, True, False, True, False, True]


def test_ngrams_and_term_counts(spark):
    arr = F.array(*[F.lit(w) for w in "b a b".split()])
    assert one(spark, K.ngrams(arr, 2)) == ["b a", "a b"]
    assert one(spark, K.ngrams(arr, 4)) == []
    assert [tuple(t) for t in one(spark, K.term_counts(arr))] == [("a", 1), ("b", 2)]
    assert one(spark, K.term_counts(F.array().cast("array<string>"))) == []


def test_sentence_stats(spark):
    tagged = K.tag_sentences(F.array(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("!")), F.array(F.lit("d"))))
    assert tuple(one(spark, X.sentence_stats(tagged))) == (2.0, 3, 1, 1.0)
    assert tuple(one(spark, X.sentence_stats(K.tag_sentences(F.array().cast("array<array<string>>"))))) == (0.0, 0, 0, 0.0)


def test_readability_and_sentiment(spark):
    # 6 words, 2 sentences, 9 syllables
    assert one(spark, X.flesch_score(F.lit("Banana is here. Banana is here."))) == pytest.approx(
        206.835 - 1.015 * 3 - 84.6 * (3 + 1 + 2) * 2 / 6)
    s = one(spark, X.sentiment(F.array(F.lit("Up"), F.lit("down"), F.lit("x")), {"up": 2.0, "down": -1.0}))
    assert s == pytest.approx(0.25)


def test_guarded_ratio_and_threshold(spark):
    assert one(spark, P.guarded_ratio(F.lit(3), F.lit(0))) == 0.0
    assert one(spark, P.guarded_ratio(F.lit(3), F.lit(2))) == 1.5
    assert [one(spark, P.threshold(F.lit(p))) for p in (0.49, 0.5, 0.51)] == [0, 1, 1]


def test_bad_word_counts(spark):
    df = spark.createDataFrame([(1, "aa bb aa")], "doc_id long, comment_text string")
    r = X.add_features(df, ["num_bad_x", "num_bad_y"], categories={"x": ["aa", "cc dd"], "y": ["bb"]}).first()
    assert (r["num_bad_x"], r["num_bad_y"]) == (2, 1)
