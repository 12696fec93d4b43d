"""Removal of repeated word sequences with prefix-partitioned suffix trees.

Every start of a whole window (20 words of one document) is a suffix. Suffixes are split by a prefix of
variable length: the first word, or the first 2, 4 or 8 where fewer words would make a group larger than
``GROUP``; counts over all documents decide that. Each group then is a memory-sized subtree. It is built
to the depth of a window, the path to that depth named by a 56-bit hash that is independent of the
prefix's: leaves in order of the path are the tree's leaves from left to right, and leaves with one path
hang under one deep internal node, a repeat. All its leaves but the earliest are repeats of an earlier
start; runs of such starts in a document are the maximal repeats, and their words go.

Before a group is gathered, each block of documents builds its own part of the subtrees: it keeps the
earliest leaf of a node and settles the others at once. A group therefore gets a repeat at most once per
block, however many copies there are. A prefix of 8 words that is still too frequent is split by the
whole path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentscope.llm.common import covered, mixed, named_apart, narrow, numbered, packed, slices, tag_bits, unpacked, whole_windows, window_hashes, word_hashes, words_of

#: Suffixes of a subtree, about; and words of a block that a task works on at a time. Both bound memory.
GROUP = 2_000_000
BLOCK = 1_000_000
PREFIXES = (1, 2, 4, 8)


def _slots(prefix: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(prefix) >> np.uint64(64 - bits)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Suffixes per slot of each prefix length."""
    total = np.zeros((len(PREFIXES), 1 << bits), np.int64)
    for part in (s for batch in batches for s in slices(batch, 0)):
        words, bounds = words_of(part.column(0).cast(pa.large_binary()).to_pylist())
        inside = whole_windows(bounds, width, len(words))
        hashes = window_hashes(word_hashes(words), width)
        for i, n in enumerate(PREFIXES):
            if n <= width and len(inside):
                total[i] += np.bincount(_slots(hashes[n][:len(inside)][inside], bits), minlength=1 << bits)
    level, slot = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(level.astype(np.int32)), pa.array(slot), pa.array(total[level, slot])], ["level", "slot", "n"])


def _leaves(batches: Iterator[pa.RecordBatch], width: int, bits: int, hot: list[frozenset[int]]) -> Iterator[pa.RecordBatch]:
    """Per block and group the leaves that the block keeps; starts that it settles itself under negative groups."""
    hot_slots = []
    for slots in hot:
        table = np.zeros(1 << bits, bool)
        table[list(slots)] = True
        hot_slots.append(table)
    docs: list[tuple[int, str, np.ndarray]] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        docs.sort(key=lambda d: d[:2])
        own = [d for i, d in enumerate(docs) if i == 0 or d[:2] != docs[i - 1][:2]]
        oid, tag = np.array([d[0] for d in own], np.int64), np.array([d[1] for d in own], "S")
        bounds = np.zeros(len(own) + 1, np.int64)
        np.cumsum([len(d[2]) for d in own], out=bounds[1:])
        words = np.concatenate([d[2] for d in own])
        starts = np.flatnonzero(whole_windows(bounds, width, len(words)))
        if not len(starts):
            return
        hashes = window_hashes(words, width)
        whole_path = mixed(hashes[width][starts])
        path = whole_path >> np.uint64(8)
        order = np.argsort(path, kind="stable")
        sorted_path = path[order]
        first = np.ones(len(order), bool)
        first[1:] = sorted_path[1:] != sorted_path[:-1]
        later = np.sort(starts[order[~first]])
        rows: list[tuple[int, bytes]] = []
        if len(later):
            doc = np.searchsorted(bounds, later, side="right") - 1
            rows.append((-1 - int(oid[0] & 0xFFFF), packed(oid[doc], tag[doc], (later - bounds[doc]).astype(np.uint32))))
        kept, kept_path = starts[order[first]], sorted_path[first]
        group = np.full(len(kept), -1, np.int64)
        for i, n in enumerate(PREFIXES):
            slot = _slots(hashes[n][kept], bits)
            group = np.where((group < 0) & ~hot_slots[i][slot], (i << 40) + slot, group)
        deep = (len(PREFIXES) << 40) + _slots(whole_path[order[first]], bits)
        group = np.where(group < 0, deep, group)
        by_group = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[by_group])) + 1
        for part in np.split(by_group, cuts):
            at = kept[part]
            doc = np.searchsorted(bounds, at, side="right") - 1
            named, local = np.unique(doc, return_inverse=True)
            keys = kept_path[part]
            rows.append((int(group[part[0]]), packed(
                np.diff(keys, prepend=np.uint64(0)), narrow(local), narrow(at - bounds[doc]), np.diff(oid[named], prepend=np.int64(0)), tag[named])))
        for i in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + 64]], pa.int64()), pa.array([r[1] for r in rows[i:i + 64]], pa.binary())], ["group", "leaves"])

    for part in (s for batch in batches for s in slices(batch, 2)):
        words, bounds = words_of(part.column(2).cast(pa.large_binary()).to_pylist())
        hashes = word_hashes(words)
        for oid, tag, a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                docs.append((oid, tag, hashes[a:b]))
                held += b - a
        if held >= BLOCK:
            yield from flush()
            docs.clear()
            held = 0
    if docs:
        yield from flush()


def dealt(oid: np.ndarray, tag: np.ndarray, bits: int, *values: np.ndarray) -> pa.Table:
    """Records of documents packed per bucket of documents: (bucket, records)."""
    bucket = (mixed(oid.view(np.uint64) ^ tag_bits(tag)) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((values[0], tag, oid, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    rows = []
    for part in np.split(order, cuts) if len(order) else []:
        named = np.ones(len(part), bool)
        named[1:] = (oid[part][1:] != oid[part][:-1]) | (tag[part][1:] != tag[part][:-1])
        first, local = part[named], np.cumsum(named) - 1
        rows.append((int(bucket[part[0]]), packed(np.diff(oid[first], prepend=np.int64(0)), tag[first], np.bincount(local), *(narrow(v[part]) for v in values))))
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "records": pa.array([r[1] for r in rows], pa.binary())})


def gathered(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All records of a bucket, in order of document and first value: oid, tag, values, and where documents begin."""
    parts = [unpacked(b) for b in table.column("records").to_pylist()]
    oid = np.concatenate([np.repeat(np.cumsum(p[0]), p[2]) for p in parts])
    tag = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
    values = [np.concatenate([p[k].astype(np.int64) for p in parts]) for k in range(3, len(parts[0]))]
    order = np.lexsort((values[0], tag, oid))
    oid, tag = oid[order], tag[order]
    heads = np.flatnonzero(np.concatenate([[True], (oid[1:] != oid[:-1]) | (tag[1:] != tag[:-1])]))
    return oid, tag, [v[order] for v in values], heads


def marks_of(key: tuple, table: pa.Table) -> pa.Table:
    """One row per document with its marked starts."""
    oid, tag, (start,), heads = gathered(table)
    blobs = [x.astype("<u4").tobytes() for x in np.split(start, heads[1:])]
    return pa.table({"m_oid": pa.array(oid[heads], pa.int64()), "m_tag": pa.array(tag[heads].astype(str), pa.string()), "starts": pa.array(blobs, pa.binary())})


def subtree(key: tuple, table: pa.Table, bits: int) -> pa.Table:
    """The repeated starts of one group: leaves under a node, but the earliest."""
    blobs = [unpacked(b) for b in table.column("leaves").to_pylist()]
    if key[0].as_py() < 0:
        oid, tag, start = (np.concatenate(x) for x in zip(*blobs))
        return dealt(oid, tag, bits, start)
    path, oid, tag, start = [], [], [], []
    for gaps, local, at, ids, tags in blobs:
        path.append(np.cumsum(gaps))
        oid.append(np.cumsum(ids)[local])
        tag.append(tags[local])
        start.append(at.astype(np.uint32))
    path, oid, tag, start = (np.concatenate(x) for x in (path, oid, tag, start))
    order = np.argsort(path, kind="stable")
    same = path[order][1:] == path[order][:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    at = order[shared]
    path, oid, tag, start = path[at], oid[at], tag[at], start[at]
    order = np.lexsort((start, tag, oid, path))
    path, oid, tag, start = path[order], oid[order], tag[order], start[order]
    head = np.ones(len(path), bool)
    head[1:] = path[1:] != path[:-1]
    first = np.maximum.accumulate(np.where(head, np.arange(len(path)), 0))
    later = (oid != oid[first]) | (tag != tag[first]) | (start != start[first])
    return dealt(oid[later], tag[later], bits, start[later])


RECORDS, MARKS = "bucket long, records binary", "m_oid long, m_tag string, starts binary"


def marks(leaves: DataFrame, bits: int) -> DataFrame:
    """(m_oid, m_tag, starts): from groups of leaves to buckets of documents, then one row per document."""
    found = leaves.groupBy("group").applyInArrow(lambda key, table: subtree(key, table, bits), RECORDS)
    return found.groupBy("bucket").applyInArrow(marks_of, MARKS)


def _removed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for part in (s for batch in batches for s in slices(batch, 1)):
        n_words, n_removed, digests, texts = [], [], [], []
        for text, starts in zip(part.column(1).cast(pa.large_binary()).to_pylist(), part.column(2).to_pylist()):
            words = text.split()
            kept = words
            if starts:
                gone = covered(np.frombuffer(starts, "<u4").astype(np.int64), width, len(words))
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            whole = b" ".join(kept)
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(whole).hexdigest())
            texts.append(whole)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, width: int = 20, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept (the words left, joined by a space).

    A word goes when a window over it also starts earlier: in a smaller doc_id (null ids last), or at an
    earlier start of the same document. Rows with the same id and another text are ordered by the md5 of
    the text; rows equal in id and text are one document and get equal results. Null texts are empty.
    Documents shorter than a window lose nothing. Other columns are ignored; an empty table gives no rows.
    Two different windows in one group are taken for equal with a chance of 2**-56.
    """
    rows = named_apart(numbered(docs, id_col, text_col))
    letters = rows.agg(F.sum(F.length("text"))).head()[0] or 0
    bits = max(4, (letters // 6 // group).bit_length())
    counts = rows.select("text").mapInArrow(partial(_counts, width=width, bits=bits), "level int, slot long, n long")
    # at most (prefix lengths * suffixes / group) slots are over the size of a group
    over = counts.groupBy("level", "slot").agg(F.sum("n").alias("n")).where(F.col("n") > group).collect()
    hot = [frozenset(r["slot"] for r in over if r["level"] == i) for i in range(len(PREFIXES))]
    leaves = rows.select("oid", "tag", "text").mapInArrow(partial(_leaves, width=width, bits=bits, hot=hot), "group long, leaves binary")
    joined = rows.join(marks(leaves, bits), (F.col("oid") == F.col("m_oid")) & (F.col("tag") == F.col("m_tag")), "left")
    return joined.select("doc_id", "text", "starts").mapInArrow(
        partial(_removed, width=width), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
