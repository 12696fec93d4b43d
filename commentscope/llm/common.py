"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commentscope.session import ensure_checkpoint_dir

#: The bytes that separate words.
SPACES = bytes([32, 9, 10, 11, 12, 13])


# ---- tables in the shared folder ----------------------------------------------------------

def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the driver and all executors see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        ensure_checkpoint_dir(spark)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder once and read back: lineage ends here."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Marks a table for broadcast when a count finds it small; otherwise the join stays a shuffled one."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))


def row_name(id_col: str, text_col: str) -> tuple[Column, Column]:
    """(oid, tag): the id, null ids last, and the md5 of the text. Together they name a row of a table;
    rows equal in id and text are one document that stands in it more than once."""
    return F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(2**63 - 1)), F.md5(text_or_empty(text_col).cast("binary"))


def one_per_name(docs: DataFrame, names: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``names`` (oid, tag, ...) lists, each once, with the other columns of ``names``."""
    oid, tag = row_name(id_col, text_col)
    keyed = docs.withColumns({"__oid": oid, "__tag": tag})
    listed = names.select(F.col("oid").alias("__n_oid"), F.col("tag").alias("__n_tag"), *[F.col(c).alias("__n_" + c) for c in names.columns if c not in ("oid", "tag")])
    joined = keyed.join(listed, (F.col("__oid") == F.col("__n_oid")) & (F.col("__tag") == F.col("__n_tag")))
    one = Window.partitionBy("__oid", "__tag").orderBy("__oid")
    return joined.withColumn("__row", F.row_number().over(one)).where("__row = 1")


def bounded_sample(df: DataFrame, rows: int, key: Column) -> DataFrame:
    """At most ``rows`` rows, those with the smallest values of a 64-bit hash ``key``: reruns agree.

    A count sets a bound on the hash first, so the ordering sees little more than the sample, however
    many partitions there are.
    """
    n = df.count()
    keyed = df.withColumn("__key", F.shiftrightunsigned(key, 1))
    if n > 2 * (rows + 30):
        keyed = keyed.where(F.col("__key") < int(1.3 * (rows + 30) / n * 2**63))
    return keyed.orderBy("__key").limit(rows).drop("__key")


# ---- text columns of Arrow batches ---------------------------------------------------------

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the bounds of its rows in them."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of text each; a longer text is a part of its own."""
    _, bounds = text_bytes(batch.column(column))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts one after another, and the bounds of each text's words."""
    split = [t.split() for t in texts]
    bounds = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(w) for w in split], out=bounds[1:])
    return [w for ws in split for w in ws], bounds


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(values: np.ndarray, width: int, multiplier: int = 0xD6E8FEB86659FD93) -> dict[int, np.ndarray]:
    """Hashes of all runs of 1, 2, 4, ... and ``width`` values, by doubling.

    Entry ``n`` holds at ``i`` the hash of ``values[i:i+n]``, for every ``i`` with ``i + n <= len(values)``.
    """
    base = multiplier
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    out, n = {1: values}, 1
    while 2 * n <= width:
        h = out[n]
        out[2 * n] = h[:max(0, len(h) - n)] * power(n) + h[n:]
        n *= 2
    done, h = n, out[n]
    while done < width:
        part = 1 << ((width - done).bit_length() - 1)
        tail = out[part][done:]
        m = max(0, len(values) - done - part + 1)
        h = h[:m] * power(part) + tail[:m]
        done += part
    out[width] = h
    return out


def whole_windows(bounds: np.ndarray, width: int, total: int) -> np.ndarray:
    """True at every start of a window of ``width`` items that stays inside its row."""
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(total)
    return left[:max(0, total - width + 1)] >= width


def covered(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """True at every item covered by a window of ``width`` items from one of the starts."""
    step = np.zeros(total + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, total), -1)
    return np.cumsum(step[:total]) > 0


# ---- tokens --------------------------------------------------------------------------------

@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


# ---- arrays as bytes -----------------------------------------------------------------------

def packed(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, compressed; bytes of equal weight lie together. A sorted array of 64-bit
    unsigned values is best passed as its differences."""
    import zstandard
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros((a.itemsize, 0), np.uint8)
        out += [a.dtype.str.ljust(4).encode(), len(a).to_bytes(8, "little"), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(data: bytes) -> list[np.ndarray]:
    import zstandard
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        kind, n = np.dtype(raw[at:at + 4].decode().strip()), int.from_bytes(raw[at + 4:at + 12], "little")
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all values."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.min_scalar_type(top))


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, oid, tag, text): oid orders the documents, null ids last; oid and tag name a row."""
    oid, tag = row_name(id_col, text_col)
    return docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), oid.alias("oid"), tag.alias("tag"), text_or_empty(text_col).alias("text"))


def named_apart(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """The rows of ``numbered`` with an empty tag where the id stands on one row alone and names it already.

    Of more than ``most`` repeated ids every row keeps its tag: no text is shuffled for this.
    """
    repeated = written(rows.groupBy("oid").count().where("count > 1").select(F.col("oid").alias("r_oid")), "repeated-ids")
    if repeated.count() > most:
        return rows
    found = rows.drop("tag").join(F.broadcast(repeated), F.col("oid") == F.col("r_oid"), "left")
    tag = F.when(F.col("r_oid").isNotNull(), F.md5(F.col("text").cast("binary"))).otherwise("")
    return found.select("doc_id", "oid", tag.alias("tag"), "text")


def tag_bits(tag: np.ndarray) -> np.ndarray:
    """64 bits of each tag, to deal out documents by; they do not name a text."""
    return np.bitwise_xor.reduce(mixed(tag.astype("S32").view(np.uint64).reshape(-1, 4)), axis=1)
