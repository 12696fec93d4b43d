"""Features whose word lists are tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.functions import features as X
from commentscope.functions import tokens as K
from commentscope.functions.predicates import guarded_ratio
from commentscope.operators import lookups as J
from commentscope.plans import dictionaries as D


def answered_by_tables(names: list[str], categories: list[str]) -> list[str]:
    """The counts behind the named features that word tables answer."""
    answered = ["num_stop_words", "sentiment", *[f"num_bad_{c}" for c in categories]]
    needed = {n if n in answered else f"num_{n.removesuffix('_vs_length').removesuffix('_vs_words')}" for n in names}
    return [a for a in answered if a in needed]


def add_features_from_tables(df: DataFrame, keep: list[str], categories: list[str], stop_words: DataFrame | None = None, bad_words: DataFrame | None = None,
                             valences: DataFrame | None = None, column: str = "comment_text", exceptions: DataFrame | None = None,
                             vocabulary: DataFrame | None = None, batch: int = D.BATCH) -> DataFrame:
    """``add_features`` with word tables of any size as DataFrames: stop words (word), bad words (word, category)
    and valences (word, value), of which those are needed that the named features ask for.

    The text is read and tokenised once. Everything that needs no table is computed in that projection; the token
    columns go into packed batches, and one join of each batch's distinct words with all tables answers stop words,
    bad words and valences together. Bad words are looked up by the lemma of a word; singular forms are those of
    ``vocabulary`` (word) and of the bad words. A word that stands in a table repeatedly counts once per category
    or as a stop word, and with the sum of its valences. A null text is an empty one.
    """
    answered = answered_by_tables(keep, categories)
    stems = {f"bad_{c}" for c in categories} | {"stop_words"}
    inside = [n for n in keep if n not in answered and n.removesuffix("_vs_length").removesuffix("_vs_words") not in stems]
    plain = list(dict.fromkeys([*inside, "text_length", "num_words"]))
    bad = any(a.startswith("num_bad_") for a in answered)
    others = [c for c in df.columns if c != column]
    tagged = bad or any(n in X.TAGGED or any(w in n for w in ("nouns", "adjectives", "verbs")) for n in inside)
    rows = X.prepare(df, column, tags=tagged, lemmas=False)
    tokens = {"__plain": F.col("text_tokenized_nopunc")} if "num_stop_words" in answered else {}
    if bad:
        tokens["__content"] = K.content_words(F.col("POS_tagging_flat"))
    if "sentiment" in answered:
        tokens["__cased"] = F.transform(K.words(F.col("noise_removed_text"), ascii_only=True), lambda w: F.lower(w))
    counted = X.with_features(rows.withColumns(tokens), plain, {}, column=column)
    measures: dict[str, tuple[str, DataFrame]] = {}
    pack = D.packed(counted, sorted(tokens), batch) if tokens else None
    if "num_stop_words" in answered:
        measures["num_stop_words"] = ("__plain", stop_words.select("word", F.lit(1.0).alias("value")).distinct())
    if "sentiment" in answered:
        measures["sentiment"] = ("__cased", valences.select("word", "value"))
    if bad:
        listed = bad_words.select("word", "category").distinct()
        words = D.vocabulary(pack)
        singular = listed.select("word") if vocabulary is None else listed.select("word").unionByName(vocabulary.select("word"))
        none = df.sparkSession.createDataFrame([], "word string, lemma string")
        lemmas = J.lemma_table(words, singular.distinct(), none if exceptions is None else exceptions)
        forms = words.join(lemmas, "word", "left").select("word", F.coalesce("lemma", "word").alias("lemma"))
        meant = forms.join(listed.withColumnRenamed("word", "lemma"), "lemma").select("word", "category")
        for c in categories:
            if f"num_bad_{c}" in answered:
                measures[f"num_bad_{c}"] = ("__content", meant.where(F.col("category") == c).select("word", F.lit(1.0).alias("value")))
    if not measures:
        return counted.select(*others, *keep)
    sums = D.word_sums(counted, measures, pack=pack)

    def named(n: str) -> Column:
        if n == "sentiment":
            return X.compound_of(F.col("sentiment"))
        if n in answered:
            return F.col(n).cast("long")
        if n in inside:
            return F.col(n)
        stem, by = n.rsplit("_vs_", 1)
        return guarded_ratio(F.col(f"num_{stem}").cast("long"), F.col("text_length" if by == "length" else "num_words"))

    return sums.select(*others, *[named(n).alias(n) for n in keep])
