"""Token arrays answered from word tables of any size, without a row per token.

Rows are packed into batches: the distinct words of a batch stand in one array, and the token arrays of its
rows hold numbers into it. Only the distinct words of each batch meet a word table, in an ordinary join; the
answers come back as one array per batch, beside its rows, and each token array is rebuilt or summed by number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentscope.plans.ordering import pinned

#: Tokens of a batch, about.
BATCH = 1 << 18


def flat(column) -> tuple[pa.Array, np.ndarray]:
    """The elements of an array column one after another, and the bounds of its rows in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def lists(values, bounds) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _pack(batches: Iterator[pa.RecordBatch], tokens: list[str], most: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for whole in batches:
        arrays = {name: flat(whole.column(name)) for name in tokens}
        ends = np.sum([bounds for _, bounds in arrays.values()], axis=0)
        at = 0
        while at < len(whole):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
            pieces = [(values.slice(b[at], b[end] - b[at]), b[at:end + 1] - b[at]) for values, b in arrays.values()]
            encoded = pa.concat_arrays([v for v, _ in pieces]).dictionary_encode()
            codes = encoded.indices.fill_null(-1).cast(pa.int32())
            columns, first = {}, 0
            for name, (values, bounds) in zip(tokens, pieces):
                columns[name] = lists(codes.slice(first, len(values)), bounds)
                first += len(values)
            carried = [columns.get(name, whole.column(i).slice(at, end - at)) for i, name in enumerate(whole.schema.names)]
            rows = pa.StructArray.from_arrays(carried, whole.schema.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number]), lists(encoded.dictionary, [0, len(encoded.dictionary)]), lists(rows, [0, end - at])],
                ["batch", "words", "rows"])
            at, number = end, number + 1


def packed(df: DataFrame, tokens: list[str], batch: int = BATCH) -> DataFrame:
    """(batch, words, rows), written once: the rows of ``df`` with numbers in place of the words of its token
    columns, -1 for a null word. A null token array becomes an empty one."""
    fields = [T.StructField(f.name, T.ArrayType(T.IntegerType()) if f.name in tokens else f.dataType) for f in df.schema.fields]
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("words", T.ArrayType(T.StringType())),
                           T.StructField("rows", T.ArrayType(T.StructType(fields)))])
    return pinned(df.mapInArrow(partial(_pack, tokens=tokens, most=batch), schema))


def vocabulary(pack: DataFrame) -> DataFrame:
    """(word): every distinct word of all batches."""
    return pack.select(F.explode("words").alias("word")).distinct()


def answered(pack: DataFrame, table: DataFrame, answer: Column) -> DataFrame:
    """``pack`` with ``answers``: for each word of a batch the value of ``answer``, a column over the left join of
    (word) with ``table`` (word, ...), which has each word once."""
    asked = pack.select("batch", F.posexplode("words").alias("at", "word")).join(table, "word", "left")
    back = asked.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("at", answer.alias("a")))).alias("__a"))
    return pack.join(back, "batch", "left").withColumn("answers", F.transform("__a", lambda x: x["a"])).drop("__a", "words")


def _unpacked(rows: pa.Array) -> tuple[pa.StructArray, list[str]]:
    values = flat(rows)[0]
    return values, [f.name for f in values.type]


def _rebuild(batches: Iterator[pa.RecordBatch], tokens: str) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(len(whole)):
            row = whole.slice(i, 1)
            values, names = _unpacked(row.column("rows"))
            answers = flat(row.column("answers"))[0]
            fields = dict(zip(names, values.flatten()))
            codes, bounds = flat(fields[tokens])
            fields[tokens] = lists(answers.take(codes), bounds)
            yield pa.RecordBatch.from_arrays(list(fields.values()), names)


def replaced(df: DataFrame, tokens: str, table: DataFrame, answer: Column, batch: int = BATCH, pack: DataFrame | None = None) -> DataFrame:
    """``df`` with each word of the token column ``tokens`` replaced by ``answer``, which is never null; the words
    of the column hold no nulls. Order, repeats and rows without words stay; a null array becomes an empty one."""
    pack = packed(df, [tokens], batch) if pack is None else pack
    return answered(pack, table, answer).select("rows", "answers").mapInArrow(partial(_rebuild, tokens=tokens), df.schema)


def _sums(batches: Iterator[pa.RecordBatch], measures: list[tuple[str, str]], tokens: list[str]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(len(whole)):
            row = whole.slice(i, 1)
            values, names = _unpacked(row.column("rows"))
            answers = flat(flat(row.column("answers"))[0])[0].to_numpy(zero_copy_only=False).reshape(-1, len(measures))
            answers = np.vstack([answers, np.zeros(len(measures))])  # a null word has number -1
            fields = dict(zip(names, values.flatten()))
            coded = {name: (codes.to_numpy(), bounds) for name, (codes, bounds) in ((t, flat(fields[t])) for t in tokens)}
            out = {name: column for name, column in fields.items() if name not in tokens}
            for k, (name, column) in enumerate(measures):
                codes, bounds = coded[column]
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                out[name] = pa.array(np.bincount(doc, weights=answers[codes, k], minlength=len(bounds) - 1).astype(float))
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def word_sums(df: DataFrame, measures: dict[str, tuple[str, DataFrame]], batch: int = BATCH, pack: DataFrame | None = None) -> DataFrame:
    """``df`` without its token columns and with a double column per measure: name -> (token column, table (word,
    value)). The measure of a row is the sum of the table's values over the column's tokens, repeats included; a
    word outside the table counts nothing, one that stands in it more often counts with the sum of its values.

    All measures are answered in one join of the batches' distinct words with all tables.
    """
    tokens = sorted({column for column, _ in measures.values()})
    pack = packed(df, tokens, batch) if pack is None else pack
    names = list(measures)
    tables = [table.select("word", F.lit(k).alias("__k"), F.col("value").cast("double").alias("__v")) for k, (_, table) in enumerate(measures.values())]
    one = (reduce(DataFrame.unionByName, tables).groupBy("word")
           .agg(F.array(*[F.coalesce(F.sum(F.when(F.col("__k") == k, F.col("__v"))), F.lit(0.0)) for k in range(len(names))]).alias("__vs")))
    answer = F.coalesce("__vs", F.array(*[F.lit(0.0)] * len(names)))
    schema = T.StructType([f for f in df.schema.fields if f.name not in tokens] + [T.StructField(n, T.DoubleType()) for n in names])
    rows = answered(pack, one, answer).select("rows", "answers")
    return rows.mapInArrow(partial(_sums, measures=[(n, measures[n][0]) for n in names], tokens=tokens), schema)
