"""Document vectors from word vectors, and block-wise encoders."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentscope.operators.lookups import lookup_join
from commentscope.plans.dictionaries import answered, flat, lists, packed

Encoder = Callable[[np.ndarray, np.ndarray], np.ndarray]
STEPS = 2 ** 32


def uniform_from(*keys: Column) -> Column:
    """Repeatable number in [0, 1) drawn from the first 32 bits of the keys' md5."""
    first = F.substring(F.md5(F.concat_ws(":", *[k.cast("string") for k in keys])), 1, 8)
    return F.conv(first, 16, 10).cast("double") / F.lit(float(STEPS))


def lookup_vectors(rows: DataFrame, vectors: DataFrame, k: int,
                   fill: Callable[[Column], Column] | None = None) -> DataFrame:
    """Left join of (…, word) with (word, vec): the first k numbers, zeros where unseen."""
    zeros = F.array_repeat(F.lit(0.0), k)
    found = F.transform(F.slice("vec", 1, k), lambda x: x.cast("double"))
    missing = zeros if fill is None else fill(F.col("word"))
    joined = lookup_join(rows, vectors.select("word", "vec"), "word")
    return joined.withColumn("vec", F.coalesce(found, F.when(F.col("word").isNull(), zeros).otherwise(missing)))


def document_vectors(df: DataFrame, key: str, tokens: str | Column, vectors: DataFrame, k: int,
                     fill_missing: bool = False, seed: int = 0) -> DataFrame:
    """(key, vec): mean of the word vectors over all tokens, zeros for a text without tokens.

    Documents are packed into batches; the distinct words of a batch meet the vectors once, and the batch averages
    its documents by number. Only rows of one key are added up in a shuffle, one vector each, a text without tokens
    as one token. An unseen word counts as zeros, or as a repeatable uniform vector.
    """
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = df.select(key, c.alias("__t"))
    found = F.transform(F.slice("vec", 1, k), lambda x: x.cast("double"))
    missing = (F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: uniform_from(F.col("word"), i, F.lit(seed)))
               if fill_missing else F.array_repeat(F.lit(0.0), k))
    pack = packed(rows, ["__t"])
    asked = answered(pack, vectors.select("word", "vec"), F.when(F.col("vec").isNull(), missing).otherwise(found))
    schema = T.StructType([df.schema[key], T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("tf", T.DoubleType())])
    seen = asked.select("rows", "answers").mapInArrow(partial(_means, key=key, k=k), schema)
    mean = Summarizer.mean(array_to_vector(F.col("vec")), F.col("tf"))
    return seen.groupBy(key).agg(mean.alias("__m")).select(key, vector_to_array("__m").alias("vec"))


def _means(batches: Iterator[pa.RecordBatch], key: str, k: int) -> Iterator[pa.RecordBatch]:
    """(key, vec, tf) of each row of the batches: the mean of its tokens' answers and their number, one at least."""
    for whole in batches:
        for i in range(len(whole)):
            row = whole.slice(i, 1)
            rows = flat(row.column("rows"))[0]
            fields = dict(zip([f.name for f in rows.type], rows.flatten()))
            answers = flat(flat(row.column("answers"))[0])[0].to_numpy(zero_copy_only=False).reshape(-1, k)
            answers = np.vstack([answers, np.zeros(k)])  # a null word has number -1
            codes, bounds = flat(fields["__t"])
            codes, sizes = codes.to_numpy(), np.diff(bounds)
            doc, tf = np.repeat(np.arange(len(sizes)), sizes), np.maximum(sizes, 1).astype(float)
            sums = np.column_stack([np.bincount(doc, weights=answers[codes, j], minlength=len(sizes)) for j in range(k)])
            vecs = lists(pa.array((sums / tf[:, None]).reshape(-1)), np.arange(len(sizes) + 1) * k)
            yield pa.RecordBatch.from_arrays([fields[key], vecs, pa.array(tf)], [key, "vec", "tf"])


def embedding_matrix(vocab: DataFrame, vectors: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(word, idx, vec) for every vocabulary word; a missing word is drawn from the normal
    distribution with the mean and deviation of all vector entries, repeatably."""
    entries = vectors.select(F.explode(F.slice("vec", 1, k)).alias("x"))
    # exactly one row on the right
    stats = entries.agg(F.avg("x").alias("__mean"), F.stddev_pop("x").alias("__std"))
    u = lambda i, part: (uniform_from(F.col("word"), i, F.lit(seed), F.lit(part))
                         + F.lit(0.5 / STEPS))
    normal = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.col("__mean") + F.col("__std")
                         * F.sqrt(-2.0 * F.log(u(i, 1))) * F.cos(F.lit(6.283185307179586) * u(i, 2)))
    found = F.transform(F.slice("vec", 1, k), lambda x: x.cast("double"))
    return (vocab.join(vectors.select("word", "vec"), "word", "left").join(F.broadcast(stats))
                 .select("word", "idx", F.coalesce(found, normal).alias("vec")))


def hashed_positions(tokens: Column, k: int) -> Column:
    """The tokens' numbers in a vocabulary of ``k`` hashed positions, from the first 32 bits of their md5."""
    return F.transform(tokens, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % k).cast("int"))


def _encoded(batches: Iterator[pa.RecordBatch], encode: Encoder, budget: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, bounds = flat(batch.column(1))
        values, sizes = values.to_numpy(), np.diff(bounds)
        order = np.argsort(sizes, kind="stable")  # texts of like length share a matrix
        at = 0
        while at < len(order):
            # as many texts as their number times the longest fits into the budget; one longer text alone
            widths = np.maximum(sizes[order[at:]], 1)
            fits = widths * np.arange(1, len(widths) + 1) <= budget
            own = order[at:at + max(1, len(fits) if fits.all() else int(fits.argmin()))]
            width = int(max(1, sizes[own].max()))
            mask = np.arange(width) < sizes[own][:, None]
            ids = np.zeros((len(own), width), np.int64)
            ids[mask] = values[np.repeat(bounds[own] - np.cumsum(sizes[own]) + sizes[own], sizes[own]) + np.arange(sizes[own].sum())]
            vecs = np.asarray(encode(ids, mask), float)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), lists(pa.array(vecs.reshape(-1)), np.arange(len(own) + 1) * vecs.shape[1])],
                                             [batch.schema.names[0], "vec"])
            at += len(own)


#: Tokens of a padded matrix, at most, unless one text is longer.
BUDGET = 1 << 18


def encode_batches(df: DataFrame, key: str, ids: str, encode: Encoder, budget: int = BUDGET) -> DataFrame:
    """(key, vec) from an encoder of padded matrices of token numbers.

    The encoder takes (numbers, mask), one row per text, and returns one vector per row. Texts of an Arrow batch
    are ordered by length and dealt into matrices of at most ``budget`` entries, so little is padding and memory
    is bounded; a longer text is a matrix of its own. Every row is encoded, a null array as a text without tokens.
    """
    schema = T.StructType([df.schema[key], T.StructField("vec", T.ArrayType(T.DoubleType()))])
    return df.select(key, ids).mapInArrow(partial(_encoded, encode=encode, budget=budget), schema)


def bag_of_positions(k: int) -> Encoder:
    """Stand-in encoder: how often each of ``k`` token numbers occurs, scaled to length one."""
    def encode(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        row = np.nonzero(mask)[0]
        counts = np.bincount(row * k + ids[mask], minlength=len(ids) * k).reshape(len(ids), k).astype(float)
        norms = np.linalg.norm(counts, axis=1, keepdims=True)
        return counts / np.where(norms == 0, 1.0, norms)

    return encode


def encode_blocks(df: DataFrame, key: str, text: str, encode: Callable, k: int) -> DataFrame:
    """(key, vec) from an encoder of a list of texts, called once per Arrow batch.

    The batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``; the encoder is
    shipped with the function and set up once per task by the caller's closure.
    """
    schema = T.StructType([df.schema[key], T.StructField("vec", T.ArrayType(T.DoubleType()))])

    def blocks(batches: Iterator):
        for batch in batches:
            vecs = encode(batch[text].tolist())
            yield batch[[key]].assign(vec=[[float(x) for x in v] for v in vecs])

    return df.select(key, F.coalesce(text, F.lit("")).alias(text)).mapInPandas(blocks, schema)
