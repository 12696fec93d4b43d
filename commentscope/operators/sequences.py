"""Integer sequences for sequence models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.operators.corpus import top_k
from commentscope.operators.lookups import corpus_vocabulary, lookup_join


def vocab_index(df: DataFrame, tokens: str | Column, num_words: int) -> DataFrame:
    """(word, n, idx): the num_words - 1 most frequent words, 1 = most frequent."""
    top = top_k(corpus_vocabulary(df, tokens), "n", ["word"], num_words - 1)
    # the window sees at most num_words rows
    return top.withColumn("idx", F.row_number().over(Window.orderBy(F.desc("n"), "word")))


def texts_to_sequences(df: DataFrame, key: str, tokens: str | Column, vocab: DataFrame) -> DataFrame:
    """(key, seq): known words as indexes in text order; a text without any keeps an empty list."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = df.select(key, F.posexplode_outer(c).alias("pos", "word"))
    found = lookup_join(rows, vocab.select("word", "idx"), "word")
    pairs = F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("pos", "idx")))
    grouped = found.groupBy(key).agg(F.sort_array(pairs).alias("__a"))
    return grouped.select(key, F.transform("__a", lambda t: t["idx"]).alias("seq"))


def pad_front(seq: Column, length: int) -> Column:
    """Fixed length: zeros in front of short sequences, the end of long ones."""
    size = F.size(seq)
    tail = F.slice(seq, F.greatest(size - length + 1, F.lit(1)), F.lit(length))
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(length) - size, F.lit(0)))
    return F.concat(zeros, tail)
