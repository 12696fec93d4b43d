"""The 68 numeric features of a comment.

``prepare`` adds the token columns once; every feature is then an expression over the
prepared row, so the whole table is one projection with no shuffle, and a query that
keeps a few features pays only for those.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.functions import text as T
from commentscope.functions import tokens as K
from commentscope.functions.binding import bind
from commentscope.functions.lexicons import CATEGORY_WORDS, LEMMA_VOCABULARY, STOP_WORDS, VALENCE
from commentscope.functions.predicates import guarded_ratio, is_punctuation

# Patterns and tag sets that decide the results. The word class is spelled
# out because the short form covers ASCII letters only.
WORD_CHAR = r"[\p{L}\p{N}_]"
TIMESTAMP = r"\d{2}:\d{2}"
DATE_LONG = rf"\D\d{{2}}:\d{{2}}, \d{{1,2}} {WORD_CHAR}+ \d{{4}}"
DATE_SHORT = rf"\D\d{{1,2}} {WORD_CHAR}+ \d{{4}}"
IP_ADDRESS = r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"
HTTP_LINK = rf"http[s]{{0,1}}://{T.NON_SPACE}+"
MAIL_ADDRESS = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
NOUN_TAGS = ["NN", "NNP", "NNPS", "NNS"]
ADJECTIVE_TAGS = ["JJ", "JJR", "JJS"]
VERB_TAGS = ["VB", "VBD", "VBG", "VBN", "VBP", "VBZ"]
READING_WORD = "[A-Za-z][A-Za-z']*"
SENTENCE_END = r"[.!?]+(?:\s|\z)"
VOWEL_GROUP = "[aeiouyAEIOUY]+"
VOWEL_WORD = (r"(?:[B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz][B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz']*+)?+"
              r"[aeiouyAEIOUY][A-Za-z']*+")

CATEGORIES = list(CATEGORY_WORDS)
# counts that also appear divided by length and by words: column stem -> ratio stem
COUNTED = ["stop_words", "exclamation_marks", "question_marks", "punctuations", "unique_words",
           "repeated_words", "nouns", "adjectives", "verbs", "uppercase", "uppercase_words"]


def feature_names(categories=None) -> list[str]:
    names = ["text_length", "num_sentences", "average_length", "max_length", "min_length",
             "std_length", "num_words", "num_words_vs_length", "length_vs_num_words"]
    for stem in COUNTED:
        names += [f"num_{stem}", f"{stem}_vs_length", f"{stem}_vs_words"]
    names += ["num_timestamp", "num_date_long", "num_date_short", "num_ip", "num_http",
              "num_mail", "readability", "sentiment"]
    for cat in CATEGORIES if categories is None else categories:
        names += [f"num_bad_{cat}", f"bad_{cat}_vs_length", f"bad_{cat}_vs_words"]
    return names


# the subset the scoring path needs
SERVING_FEATURES = (
    ["text_length", "min_length", "num_words", "num_words_vs_length", "num_exclamation_marks",
     "exclamation_marks_vs_length", "num_unique_words", "num_verbs", "verbs_vs_length",
     "num_uppercase", "uppercase_vs_length", "sentiment"]
    + [f"{p}{c}{s}" for c in CATEGORIES for p, s in (("num_bad_", ""), ("bad_", "_vs_length"))]
)

# the features that go into a model, three of them scaled
MODEL_FEATURES = (
    ["min_length", "num_words_vs_length", "exclamation_marks_vs_length", "num_unique_words",
     "verbs_vs_length", "num_uppercase", "uppercase_vs_length", "sentiment"]
    + [f"bad_{c}_vs_length" for c in CATEGORIES]
)
SCALED_FEATURES = ["min_length", "num_unique_words", "num_uppercase"]


def prepare(df: DataFrame, column: str = "comment_text", lexicon=None, exceptions=None,
            vocabulary=None, tags: bool = True, lemmas: bool = True) -> DataFrame:
    """Add the cleaned text, the token lists and, unless declined, tagged sentences and lemmas."""
    clean = F.col("clean_text")
    out = (T.clean_comments(df, column)
            .withColumns({"text_tokenized": K.words(clean, ascii_only=True),
                          "text_tokenized_nopunc": K.words_no_punctuation(clean)}))
    if tags or lemmas:
        out = (out.withColumn("POS_tagging", K.tag_sentences(K.sentence_words(clean), lexicon))
                  .withColumn("POS_tagging_flat", F.flatten("POS_tagging")))
    if lemmas:
        out = out.withColumn("lemmatization",
                             K.content_lemmas(F.col("POS_tagging_flat"), exceptions, vocabulary))
    return out


def count_char(c: Column, mark: str) -> Column:
    """How many characters of a text are among the given marks."""
    left = F.replace(c, F.lit(mark), F.lit("")) if len(mark) == 1 else F.translate(c, mark, "")
    return (F.length(c) - F.length(left)).cast("long")


def count_matches(c: Column, pattern: str, needs: str = "") -> Column:
    """Number of matches; a text without the string ``needs`` skips the regex."""
    found = F.regexp_count(c, F.lit(pattern)).cast("long")
    return F.when(F.contains(c, F.lit(needs)), found).otherwise(F.lit(0).cast("long")) if needs else found


def size_where(array: Column, keep) -> Column:
    return F.size(F.filter(array, keep)).cast("long")


def sentence_stats(tagged_sentences: Column) -> Column:
    """Struct of average, max, min and population deviation of words per sentence."""
    def stats(lens: Column) -> Column:
        n = F.size(lens).cast("double")
        mean = F.aggregate(lens, F.lit(0.0), lambda a, x: a + x) / n
        squares = bind(mean, lambda m: F.aggregate(
            lens, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)))
        return F.struct(
            mean.alias("average_length"), F.array_max(lens).alias("max_length"),
            F.array_min(lens).alias("min_length"), F.sqrt(squares / n).alias("std_length"))

    lens = F.transform(tagged_sentences,
                       lambda s: size_where(s, lambda t: ~is_punctuation(t["word"])))
    zero = F.lit(0).cast("long")
    none = F.struct(F.lit(0.0).alias("average_length"), zero.alias("max_length"),
                    zero.alias("min_length"), F.lit(0.0).alias("std_length"))
    return F.coalesce(bind(lens, lambda x: F.when(F.size(x) > 0, stats(x))), none)


def once_and_repeated(comment: Column) -> Column:
    """Struct of words occurring once and of distinct words occurring more often.

    A text without any word is tried again with its spaces removed.
    """
    def counted(found: Column) -> Column:
        again = bind(F.sort_array(found), lambda s: F.array_distinct(
            F.filter(s, lambda w, i: w == F.get(s, i - 1))))
        distinct = F.size(F.array_distinct(found)).cast("long")
        return bind(F.size(again).cast("long"), lambda r: F.struct(
            (distinct - r).alias("once"), r.alias("repeated")))

    def or_joined(direct: Column) -> Column:
        return F.when(F.size(direct) > 0, direct).otherwise(
            K.vector_words(F.replace(comment, F.lit(" "), F.lit(""))))

    return bind(bind(K.vector_words(comment), or_joined), counted)


def flesch_score(c: Column) -> Column:
    """206.835 - 1.015 words/sentence - 84.6 syllables/word; a word has one syllable or more."""
    def counts(plain: Column) -> Column:
        n = count_matches(plain, READING_WORD)
        return F.struct(
            n.alias("words"), F.greatest(count_matches(plain, SENTENCE_END), F.lit(1).cast("long")).alias("ends"),
            count_matches(plain, VOWEL_GROUP).alias("vowels"), count_matches(plain, VOWEL_WORD).alias("voiced"))

    def score(s: Column) -> Column:
        n = s["words"].cast("double")
        # every vowel group is in some word; words without one still count as one
        syllables = s["vowels"] + s["words"] - s["voiced"]
        return F.when(n > 0, F.lit(206.835) - F.lit(1.015) * n / s["ends"]
                      - F.lit(84.6) * syllables / n).otherwise(0.0)

    return bind(bind(F.replace(c, F.lit("_"), F.lit(" ")), counts), score)


def word_valences(tokens: Column, table: dict[str, float] | None = None) -> Column:
    """Valence of every token, ignoring case, 0 for words outside the table."""
    table = VALENCE if table is None else table
    by_value: dict[float, list[str]] = {}
    for word, value in table.items():
        by_value.setdefault(float(value), []).append(word)

    def one(w: Column) -> Column:
        out = F.when(~w.isin(K.inline_set(table)), F.lit(0.0))
        for value, ws in by_value.items():
            out = out.when(w.isin(K.inline_set(ws)), F.lit(value))
        return out

    return F.transform(tokens, lambda w: one(F.lower(w)))


def compound_of(total: Column) -> Column:
    return total / F.sqrt(total * total + F.lit(15.0))


def sentiment(tokens: Column, table=None) -> Column:
    """Sum of valences squashed into (-1, 1)."""
    return F.aggregate(word_valences(tokens, table), F.lit(0.0), lambda a, v: a + v, compound_of)


def sentiment_components(valences: Column) -> Column:
    """Struct of positive, negative and neutral shares and the compound score."""
    start = F.struct(F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"),
                     F.lit(0.0).alias("neu"), F.lit(0.0).alias("s"))
    acc = F.aggregate(valences, start, lambda a, v: F.struct(
        (a["pos"] + F.when(v > 0, v + 1).otherwise(0.0)).alias("pos"),
        (a["neg"] + F.when(v < 0, 1 - v).otherwise(0.0)).alias("neg"),
        (a["neu"] + F.when(v == 0, 1.0).otherwise(0.0)).alias("neu"),
        (a["s"] + v).alias("s")))
    total = acc["pos"] + acc["neg"] + acc["neu"]
    return F.struct(guarded_ratio(acc["pos"], total).alias("positive"),
                    guarded_ratio(acc["neg"], total).alias("negative"),
                    guarded_ratio(acc["neu"], total).alias("neutral"),
                    compound_of(acc["s"]).alias("compound"))


def with_features(prepared: DataFrame, keep: list[str], categories=None, stop_words=None,
                  valence=None, column: str = "comment_text") -> DataFrame:
    """Add the named features to a prepared table and leave the prepared columns out."""
    categories = CATEGORY_WORDS if categories is None else categories
    stop = K.inline_set(STOP_WORDS if stop_words is None else stop_words)
    raw = T.text_or_empty(column)
    noise, words = F.col("noise_removed_text"), F.col("text_tokenized_nopunc")
    flat, lemmas = F.col("POS_tagging_flat"), F.col("lemmatization")
    stats, pair, cased = F.col("__stats"), F.col("__words"), F.col("__cased")
    tag_in = lambda tags: size_where(flat, lambda t: t["tag"].isin(tags))
    word_in = lambda array, listed: size_where(array, lambda w: w.isin(listed))

    needed = set(keep) | {"text_length", "num_words"} | {
        f"num_{stem}" for n in keep for stem in (n.removesuffix("_vs_length"), n.removesuffix("_vs_words"))}
    counts = {
        "text_length": lambda: F.char_length(raw).cast("long"),
        "num_sentences": lambda: F.size("POS_tagging").cast("long"),
        "average_length": lambda: stats["average_length"],
        "max_length": lambda: stats["max_length"],
        "min_length": lambda: stats["min_length"],
        "std_length": lambda: stats["std_length"],
        "num_words": lambda: F.size(words).cast("long"),
        "num_stop_words": lambda: word_in(words, stop),
        "num_exclamation_marks": lambda: count_char(noise, "!"),
        "num_question_marks": lambda: count_char(noise, "?"),
        "num_punctuations": lambda: count_char(noise, T.PUNCTUATION),
        "num_unique_words": lambda: pair["once"],
        "num_repeated_words": lambda: pair["repeated"],
        "num_nouns": lambda: tag_in(NOUN_TAGS),
        "num_adjectives": lambda: tag_in(ADJECTIVE_TAGS),
        "num_verbs": lambda: tag_in(VERB_TAGS),
        "num_uppercase": lambda: count_matches(noise, "[A-Z]"),
        "num_uppercase_words": lambda: size_where(
            cased, lambda w: w.rlike("[A-Z]") & ~w.rlike("[a-z]")),
        "num_timestamp": lambda: count_matches(raw, TIMESTAMP, ":"),
        "num_date_long": lambda: count_matches(raw, DATE_LONG, ":"),
        "num_date_short": lambda: count_matches(raw, DATE_SHORT),
        "num_ip": lambda: count_matches(raw, IP_ADDRESS),
        "num_http": lambda: count_matches(raw, HTTP_LINK, "://"),
        "num_mail": lambda: count_matches(raw, MAIL_ADDRESS, "@"),
        "readability": lambda: flesch_score(noise),
        "sentiment": lambda: sentiment(cased, valence),
    }
    for cat, cat_words in categories.items():
        counts[f"num_bad_{cat}"] = partial(word_in, lemmas, K.inline_set(cat_words))

    length, n_words = F.col("text_length"), F.col("num_words")
    ratios: dict[str, Column] = {
        "num_words_vs_length": guarded_ratio(n_words, length),
        "length_vs_num_words": guarded_ratio(length, n_words),
    }
    for stem in COUNTED + [f"bad_{cat}" for cat in categories]:
        if f"num_{stem}" not in needed:
            continue
        ratios[f"{stem}_vs_length"] = guarded_ratio(F.col(f"num_{stem}"), length)
        ratios[f"{stem}_vs_words"] = guarded_ratio(F.col(f"num_{stem}"), n_words)

    others = [c for c in prepared.columns if c not in PREPARED_COLUMNS]
    if needed & {"average_length", "max_length", "min_length", "std_length"}:
        prepared = prepared.withColumn("__stats", sentence_stats(F.col("POS_tagging")))
    if needed & {"num_unique_words", "num_repeated_words"}:
        prepared = prepared.withColumn("__words", once_and_repeated(raw))
    if needed & {"num_uppercase_words", "sentiment"}:
        prepared = prepared.withColumn("__cased", K.words(noise, ascii_only=True))
    counted = prepared.select(*others, *[c().alias(n) for n, c in counts.items() if n in needed])
    return counted.select(*others, *[ratios[n].alias(n) if n in ratios else F.col(n) for n in keep])


TAGGED = ["num_sentences", "average_length", "max_length", "min_length", "std_length"]
PREPARED_COLUMNS = ["comment_text", "noise_removed_text", "clean_text", "text_tokenized",
                    "text_tokenized_nopunc", "POS_tagging", "POS_tagging_flat", "lemmatization"]


def add_features(df: DataFrame, keep: list[str] | None = None, categories=None, stop_words=None,
                 valence=None, column: str = "comment_text", lexicon=None, exceptions=None,
                 vocabulary=None) -> DataFrame:
    """Raw comments to the feature table (all features unless some are named).

    The caller's word lists replace the starters; words of the caller's categories are always
    singular forms that a plural is reduced to.
    """
    if categories is not None:
        vocabulary = {*(LEMMA_VOCABULARY if vocabulary is None else vocabulary), *(w for ws in categories.values() for w in ws)}
    names = feature_names(categories) if keep is None else keep
    lemmas = any("bad_" in n for n in names)
    tags = any(n in TAGGED or any(w in n for w in ("nouns", "adjectives", "verbs")) for n in names)
    prepared = prepare(df, column, lexicon, exceptions, vocabulary, tags, lemmas)
    return with_features(prepared, names, categories, stop_words, valence, column)
