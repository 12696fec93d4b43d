"""Joins of tokens with word tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.functions import tokens as K
from commentscope.plans import dictionaries as D
from commentscope.plans.long_form import exploded


def token_rows(df: DataFrame, ids: list[str], tokens: str | Column, name: str = "word") -> DataFrame:
    """(ids, pos, word), exploded after everything else is projected away."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    # the outer form, for the reason given at ``exploded``
    return df.select(*ids, F.posexplode_outer(c).alias("pos", name)).where(F.col("pos").isNotNull())


def lookup_join(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join rows with a table that has each key once.

    A frequent word may sit on a third of all rows. Adaptive execution splits such a partition by
    its measured size and reads the table's part once for each piece; a table whose measured size
    is small is broadcast instead. The table itself is never repeated.
    """
    return rows.join(table, key, how)


def words_not_in(df: DataFrame, ids: list[str], tokens: str | Column, table: DataFrame, name: str = "words") -> DataFrame:
    """(ids, words) without the words of a table of any size; every id stays, order and repeats too."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = df.select(*ids, F.posexplode_outer(c).alias("pos", "word"))
    marked = lookup_join(rows, table.select("word", F.lit(True).alias("__listed")).distinct(), "word")
    grouped = regroup(marked, ids, F.when(F.col("__listed").isNull(), F.col("word")), name)
    return grouped.withColumn(name, F.filter(name, lambda w: w.isNotNull()))


def word_sums(df: DataFrame, ids: list[str], tokens: str | Column, table: DataFrame, value: str = "value") -> DataFrame:
    """(ids, total) of a table (word, value) over the tokens, 0 for words outside it: valences, or 1 per
    listed word for counts. Each document brings a word once, with its count."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = (df.select(*ids, K.term_counts(c).alias("__t")).select(*ids, F.inline_outer("__t"))
            .select(*ids, F.col("term").alias("word"), "tf"))
    found = lookup_join(rows, table.select("word", F.col(value).cast("double").alias("__v")), "word")
    return found.groupBy(*ids).agg(F.coalesce(F.sum(F.col("__v") * F.col("tf")), F.lit(0.0)).alias("total"))


def regroup(rows: DataFrame, ids: list[str], item: Column, name: str) -> DataFrame:
    """Rows with ``pos`` back to one array per id, in position order."""
    kept = rows.groupBy(*ids).agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos"), item.alias("__item")))).alias("__a"))
    return kept.select(*ids, F.transform("__a", lambda t: t["__item"]).alias(name))


def corpus_vocabulary(df: DataFrame, tokens: str | Column, min_count: int = 1) -> DataFrame:
    """Distinct words with their counts; partial counts keep the shuffle at vocabulary size."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    counts = exploded(df, [], c, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def lemma_table(words: DataFrame, vocabulary: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(word, lemma) for the distinct words whose lemma differs from the word."""
    ranked = F.array(*[F.struct(F.lit(i).alias("rank"), c.alias("candidate"))
                       for i, c in enumerate(K.lemma_candidates(F.col("word")))])
    tries = (words.select("word", F.explode(ranked).alias("t"))
                  .select("word", "t.rank", "t.candidate").where("candidate is not null"))
    found = (tries.join(vocabulary.select(F.col("word").alias("candidate")), "candidate", "left_semi")
                  .groupBy("word").agg(F.min_by("candidate", "rank").alias("lemma")))
    regular = found.join(exceptions, "word", "left_anti")
    return regular.unionByName(exceptions.join(words, "word", "left_semi"))


def lemmatize_with_table(df: DataFrame, ids: list[str], words: str | Column,
                         lemmas: DataFrame) -> DataFrame:
    """(ids, lemmatization) by a join with a (word, lemma) table; every id stays."""
    c = F.col(words) if isinstance(words, str) else words
    rows = df.select(*ids, F.posexplode_outer(c).alias("pos", "word"))
    joined = lookup_join(rows, lemmas, "word")
    grouped = regroup(joined, ids, F.coalesce("lemma", "word"), "lemmatization")
    return grouped.withColumn("lemmatization", F.filter("lemmatization", lambda w: w.isNotNull()))


def lemmatize_corpus(df: DataFrame, tokens: str, exceptions: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """``df`` with the words of a token column replaced by their lemmas; the vocabulary of singular forms is given
    or that of the column itself. The text is read once: the distinct words of its packed batches are the vocabulary,
    and no token is a row."""
    pack = D.packed(df, [tokens])
    words = D.vocabulary(pack)
    lemmas = lemma_table(words, words if vocabulary is None else vocabulary, exceptions)
    return D.replaced(df, tokens, lemmas, F.coalesce("lemma", "word"), pack=pack)


def tag_with_table(df: DataFrame, ids: list[str], tokens: str | Column, lexicon: DataFrame) -> DataFrame:
    """(ids, tagged) by a join with a (word, tag) table, suffix rules for the rest."""
    rows = token_rows(df, ids, tokens)
    joined = lookup_join(rows, lexicon, "word")
    guess = K.tag_word(F.col("word"), {"NN": [""]})
    return regroup(joined, ids, F.struct(F.col("word").alias("word"),
                                         F.coalesce("tag", guess).alias("tag")), "tagged")
