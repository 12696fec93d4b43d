"""Length-normalised tf-idf of a corpus, summed per term, without a shuffled row per document and term.

Documents are packed into batches: the distinct words of a batch and its documents as arrays of word numbers,
compressed. Terms are formed from a pack whenever they are needed, in the same order each time, and are never
kept. From then on

1. the distinct terms of each batch go, cut by a hash of their text, to blocks of the term table, which add document frequencies and answer each batch with those of its terms, in the order in which it sent them;
2. a batch weighs its documents with these numbers, takes each document's norm and sends back, for each of its
   terms, the sum of tf over norm;
3. the block meets the terms it was sent once more, from the same shuffle, and adds what the batches sent back.

So a term travels once as text, without a string object or an array element of its own in a row: a row has the
bytes of its terms and their lengths and counts as two compressed binary values. A task holds a pack or a block,
whose sizes do not grow with the input. Terms are equal by their text; hashes only deal them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.plans.dictionaries import flat, lists
from commentscope.plans.ordering import pinned

#: Words of a batch, and batch terms in a block, about.
BATCH, BLOCK = 1 << 19, 1 << 19

_ZSTD = pa.Codec("zstd", compression_level=3)

#: ``most`` bounds the number of a batch's distinct terms.
PACKED = "batch long, docs long, most long, pack binary"
DEALT = "block int, batch long, text binary, numbers binary"
RATED = "block int, batch long, df binary"
SUMS = "block int, batch long, sums binary"
SCORED = "term string, df long, idf double, score double"


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Numbers, or rows of numbers, as one compressed binary value per piece, after its size in bytes."""
    values = np.ascontiguousarray(values)
    data, at = memoryview(values.reshape(-1).view(np.uint8)), (bounds * values.strides[0]).tolist()
    return pa.array([(b - a).to_bytes(8, "little") + _ZSTD.compress(data[a:b], asbytes=True) for a, b in zip(at[:-1], at[1:])], pa.binary())


def _joined(column: pa.ChunkedArray, kind: type = np.uint8) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all pieces one after another, and the bounds of the pieces in them."""
    pieces = [np.frombuffer(_ZSTD.decompress(x[8:], int.from_bytes(x[:8], "little")), kind) for x in column.to_pylist()]
    return np.concatenate([np.empty(0, kind), *pieces]), np.r_[0, np.cumsum([len(x) for x in pieces], dtype=np.int64)]


def _bytes(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all terms one after another, and the bounds of the terms in them."""
    _, bounds, data = terms.cast(pa.large_binary()).buffers()
    bounds = np.frombuffer(bounds or bytes(8), np.int64)[terms.offset:terms.offset + len(terms) + 1]
    return np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words and bounds of some documents at a time, of about ``most`` words."""
    for whole in batches:
        words, bounds = flat(whole.column(0))
        at = 0
        while at < len(whole):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
            yield words.slice(bounds[at], bounds[end] - bounds[at]), bounds[at:end + 1] - bounds[at]
            at = end


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The first bytes of 32-bit numbers, then their second bytes and so on, which compress better."""
    return numbers.view(np.uint8).reshape(-1, 4).T.ravel()


def _numbers(planes: np.ndarray) -> np.ndarray:
    return planes.reshape(4, -1).T.ravel().view(np.int32)


def _packed(batches: Iterator[pa.RecordBatch], most: int, size: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for number, (words, bounds) in enumerate(_slices(batches, most)):
        encoded = words.dictionary_encode()
        codes = encoded.indices.fill_null(-1).to_numpy()
        order = np.argsort(-np.bincount(codes + 1, minlength=len(encoded.dictionary) + 1)[1:], kind="stable")  # frequent words get small numbers
        rank = np.full(len(order) + 1, -1, np.int32)
        rank[order] = np.arange(len(order))
        distinct, codes = encoded.dictionary.take(pa.array(order)), rank[codes]
        row = pa.record_batch([lists(distinct, [0, len(distinct)]), lists(pa.array(bounds), [0, len(bounds)]),
                               lists(pa.array(_planes(codes)), [0, codes.nbytes])], ["words", "bounds", "codes"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression=_ZSTD)) as stream:
            stream.write_batch(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | number]), pa.array([len(bounds) - 1]), pa.array([min(len(codes), len(distinct) ** size)], pa.int64()),
             pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch", "docs", "most", "pack"])


def _formed(pack: pa.Scalar, size: int) -> tuple[pa.Array, list[np.ndarray], np.ndarray, np.ndarray]:
    """The words of a pack, for each distinct term the numbers of its words, and for each place with a term its document
    and the term's number. A term is ``size`` consecutive words of a document; a window with a null word is none. Terms
    are numbered in the order of their last places."""
    words, bounds, code = (flat(c)[0] for c in pa.ipc.open_stream(pack.as_buffer()).read_next_batch().columns)
    code, width = _numbers(code.to_numpy()), max(1, len(words))
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds.to_numpy()))
    places = np.arange(max(0, len(code) - size + 1))
    places = places[doc[places] == doc[places + size - 1]]
    places = places[np.all([code[places + k] >= 0 for k in range(size)], axis=0)]
    key, span = code[places].astype(np.int64), width
    for k in range(1, size):
        if span * width >= 1 << 63:  # numbers of the distinct beginnings stay below the number of places
            key, span = np.unique(key, return_inverse=True)[1], len(places)
        key, span = key * width + code[places + k], span * width
    distinct, number = np.unique(key, return_inverse=True)
    at = np.empty(len(distinct), np.int64)
    at[number] = places
    order, rank = np.argsort(at), np.empty(len(at), np.int64)
    rank[order] = np.arange(len(at))
    return words, [code[at[order] + k] for k in range(size)], doc[places], rank[number]


def _hashes(words: pa.Array, parts: list[np.ndarray]) -> np.ndarray:
    """A hash of each term's text, the same wherever its words end: a polynomial of its bytes, mixed."""
    data, bounds = _bytes(words)
    lengths = np.diff(bounds)
    power = np.cumprod(np.r_[np.uint64(1), np.full(lengths.max(initial=1), 0x9E3779B97F4A7C15, np.uint64)], dtype=np.uint64)
    each = (data + np.uint64(1)) * power[np.repeat(bounds[1:], lengths) - 1 - np.arange(len(data))]
    total = np.r_[np.uint64(0), np.cumsum(each, dtype=np.uint64)]
    word = total[bounds[1:]] - total[bounds[:-1]]
    out = word[parts[0]]
    for p in parts[1:]:
        out = (out * power[1:2] + np.uint64(ord(" ") + 1)) * power[lengths[p]] + word[p]
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        out = (out ^ out >> np.uint64(33)) * np.uint64(factor)
    return out ^ out >> np.uint64(33)


def _in_blocks(words: pa.Array, parts: list[np.ndarray], all_blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order in which a pack sends its terms, the blocks it sends to, and their bounds in that order."""
    block = ((_hashes(words, parts) >> np.uint64(32)) * np.uint64(all_blocks) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(block, kind="stable")  # neighbours are of one document, with one norm, which compresses
    blocks, first = np.unique(block[order], return_index=True)
    return order, blocks, np.r_[first, len(order)]


def _pairs(doc: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents and terms that meet, and how often."""
    terms = number.max(initial=0) + 1
    pairs, tf = np.unique(doc * terms + number, return_counts=True)
    return *np.divmod(pairs, terms), tf


def _dealt(batches: Iterator[pa.RecordBatch], all_blocks: int, size: int, once: bool) -> Iterator[pa.RecordBatch]:
    """The terms of each pack cut into blocks, with the number of documents, or else places, that have them."""
    for whole in batches:
        for batch, pack in zip(whole["batch"], whole["pack"]):
            words, parts, doc, number = _formed(pack, size)
            counts = np.bincount(_pairs(doc, number)[1] if once else number, minlength=len(parts[0]))
            order, blocks, bounds = _in_blocks(words, parts, all_blocks)
            terms = pc.binary_join_element_wise(*(words.take(pa.array(p[order])) for p in parts), " ")
            data, ends = _bytes(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array(np.full(len(blocks), batch.as_py())), _cut(data, ends[bounds]),
                 _cut(np.column_stack([np.diff(ends), counts[order]]).astype(np.int32), bounds)],
                ["block", "batch", "text", "numbers"])


def _block(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of a block and their counts; the numbers of the terms each batch sent, and their bounds."""
    numbers, bounds = _joined(table["numbers"], np.int32)
    lengths, counts = numbers.reshape(-1, 2).T
    text, offsets = _joined(table["text"])[0], np.r_[0, np.cumsum(lengths, dtype=np.int64)]
    terms = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    encoded = terms.dictionary_encode()
    code = encoded.indices.to_numpy()
    counts = np.bincount(code, weights=counts, minlength=len(encoded.dictionary)).astype(np.int64)
    return encoded.dictionary.cast(pa.string()), counts, code, bounds // 2


def _idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log((1 + n) / (1 + df)) + 1


def _rated(table: pa.Table, block: pa.Table) -> pa.Table:
    """For each batch of a block the document frequencies of its terms in the block; a block may have been sent nothing."""
    _, df, code, bounds = _block(table)
    return pa.table({"block": table["block"], "batch": table["batch"], "df": _cut(df[code], bounds)})


def _weighed(batch: pa.Table, rated: pa.Table, n: int, all_blocks: int, size: int) -> pa.Table:
    """The batch's sum of tf over the document's norm for each of its terms, cut into blocks as it was sent."""
    rated = rated.sort_by("block")
    words, parts, doc, number = _formed(batch["pack"][0], size)
    order, _, bounds = _in_blocks(words, parts, all_blocks)
    idf = np.empty(len(order))
    idf[order] = _idf(_joined(rated["df"], np.int64)[0], n)
    docs = doc.max(initial=-1) + 1
    doc, number, tf = _pairs(doc, number)
    norm = np.sqrt(np.bincount(doc, weights=(tf * idf[number]) ** 2, minlength=docs))
    sums = np.bincount(number, weights=tf / norm[doc], minlength=len(order))
    return pa.table({"block": rated["block"], "batch": rated["batch"], "sums": _cut(sums[order], bounds)})


def _scored(dealt: pa.Table, sums: pa.Table, n: int) -> pa.Table:
    terms, df, code, _ = _block(dealt.sort_by("batch"))
    score = np.bincount(code, weights=_joined(sums.sort_by("batch")["sums"], np.float64)[0], minlength=len(df))
    idf = _idf(df, n)
    return pa.table({"term": terms, "df": pa.array(df), "idf": pa.array(idf), "score": pa.array(score * idf)})


def _blocks(df: DataFrame, sent: int) -> int:
    """How many blocks share the terms."""
    return max(8 * df.sparkSession.sparkContext.defaultParallelism, -(-sent // BLOCK))


def _added(table: pa.Table) -> pa.Table:
    terms, n, _, _ = _block(table)
    return pa.table({"term": terms, "n": pa.array(n)})


def term_frequencies(df: DataFrame, words: Column, size: int = 1, batch: int = BATCH) -> DataFrame:
    """(term, n): how often each term occurs, a term being ``size`` consecutive words of a row joined by spaces.

    A batch of documents sends each of its terms once, with its count; blocks of at most about ``BLOCK`` sent terms, by
    hash, add them up, so neither a task's memory nor a row per place grows with the input.
    """
    packed = pinned(df.select(words.alias("terms")).mapInArrow(partial(_packed, most=batch, size=size), PACKED))
    all_blocks = _blocks(df, packed.agg(F.coalesce(F.sum("most"), F.lit(0))).head()[0])
    dealt = packed.select("batch", "pack").mapInArrow(partial(_dealt, all_blocks=all_blocks, size=size, once=False), DEALT)
    return dealt.groupBy("block").applyInArrow(_added, "term string, n long")


def term_tfidf(df: DataFrame, terms: Column, batch: int = BATCH, size: int = 1) -> DataFrame:
    """(term, df, idf, score): for every term the sum over documents of the length-normalised tf-idf, with
    idf = ln((1 + n) / (1 + df)) + 1.

    Every row is a document; one without terms, or with a null array, counts in n only. Null terms are none. With
    ``size`` over 1 the column holds words, and a term is that many consecutive ones joined by spaces.
    """
    packed = pinned(df.select(terms.alias("terms")).mapInArrow(partial(_packed, most=batch, size=size), PACKED))
    n, sent = packed.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("most"), F.lit(0))).head()
    all_blocks = _blocks(df, sent)
    dealt = packed.select("batch", "pack").mapInArrow(partial(_dealt, all_blocks=all_blocks, size=size, once=True), DEALT)
    blocks = df.sparkSession.range(all_blocks).select(F.col("id").cast("int").alias("block"))
    rated = dealt.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_rated, RATED)
    sums = (packed.where("most > 0").select("batch", "pack").groupBy("batch").cogroup(rated.groupBy("batch"))
            .applyInArrow(lambda pack, rows: _weighed(pack, rows, n, all_blocks, size), SUMS))
    return dealt.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(lambda rows, sums: _scored(rows, sums, n), SCORED)
