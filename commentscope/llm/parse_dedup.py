"""Removal of repeated byte strings by prefix-free parsing, for highly repetitive text.

Parse. A rolling hash of ``TRIGGER`` bytes is taken everywhere; the smallest hash in a window (100 bytes)
is the window's trigger. Equal windows have the same trigger at the same offset, and every window has
one. Consecutive windows with one trigger form a phrase, the bytes they cover; phrases overlap by less
than a window, so the windows of a document lie each in exactly one phrase.

Dictionary. Phrases are sorted by trigger, then by content: equal phrases are one entry of the
dictionary, whose earliest occurrence stays; all windows of the others start earlier too. This settles
whole copies at one record per phrase, a small part of the text.

Order. What is left are windows of dictionary entries that share a trigger with a different entry: their
suffixes are sorted by content to the depth of a window (named by a 64-bit hash). Suffixes that are equal
to that depth are neighbours in the corpus' suffix order, and those that do not come first in it by
document and place repeat an earlier one. Entries whose trigger occurs in no other entry need no order.

Blocks of documents do both steps on their own first, so a group gets an equal phrase or suffix at most
once per block, however many copies there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentscope.llm.common import mixed, named_apart, narrow, numbered, packed, slices, text_bytes, unpacked, written
from commentscope.llm.substring_trees import RECORDS, dealt, gathered, marks

TRIGGER = 32
#: Bytes of a block that a task works on at a time, and phrases or suffixes of a group, about.
BLOCK = 1 << 20
GROUP = 1_000_000

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random 64-bit value per byte, from a fixed seed.
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Substrings:
    """Hashes of any substrings of a byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(_BASE, max(n, 1))[:n], out=self.sums[1:])
        self.scale = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.scale[start])

    def all(self, width: int) -> np.ndarray:
        n = max(0, len(self.sums) - width)
        return mixed((self.sums[width:width + n] - self.sums[:n]) * self.scale[:n])


def phrases(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, trigger hash, content hash) of every phrase of a block."""
    sub, n = Substrings(data), len(data)
    inside = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n) >= width
    starts = np.flatnonzero(inside)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    low_bits = np.uint64(n.bit_length())
    hashes = sub.all(TRIGGER)
    # the place in the low bits breaks ties to the left, and names the smallest
    least = ((hashes >> low_bits) << low_bits) | np.arange(len(hashes), dtype=np.uint64)
    span, have = width - TRIGGER + 1, 1
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
    trigger = (least[starts] & ((np.uint64(1) << low_bits) - np.uint64(1))).astype(np.int64)
    cut = np.ones(len(starts), bool)
    cut[1:] = (trigger[1:] != trigger[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(cut)
    first, count = starts[head], np.diff(np.append(head, len(starts)))
    content = mixed(sub.of(first, first + count - 1 + width) + count.astype(np.uint64))
    return first, count, hashes[trigger[head]], content


def _collected(batches: Iterator[pa.RecordBatch], extra: bool) -> Iterator[tuple]:
    """Blocks: (oid, tag, bounds, bytes, extra values) of documents in order, equal rows once."""
    held: list[tuple] = []
    size = 0

    def block() -> tuple:
        held.sort(key=lambda d: d[:2])
        own = [d for i, d in enumerate(held) if i == 0 or d[:2] != held[i - 1][:2]]
        bounds = np.zeros(len(own) + 1, np.int64)
        np.cumsum([len(d[2]) for d in own], out=bounds[1:])
        return (np.array([d[0] for d in own], np.int64), np.array([d[1] for d in own], "S"), bounds,
                np.frombuffer(b"".join(d[2] for d in own), np.uint8), [d[3] for d in own])

    for part in (s for batch in batches for s in slices(batch, 2)):
        texts = part.column(2).cast(pa.large_binary()).to_pylist()
        more = part.column(3).to_pylist() if extra else [None] * len(part)
        for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, more):
            held.append(row)
            size += len(row[2])
            if size >= BLOCK:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def _grouped(group: np.ndarray, doc: np.ndarray, oid: np.ndarray, tag: np.ndarray, key: np.ndarray, place: np.ndarray, *more: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Per group the records in order of key, with the documents that they name."""
    by_group = np.argsort(group, kind="stable")
    for part in np.split(by_group, np.flatnonzero(np.diff(group[by_group])) + 1):
        named, local = np.unique(doc[part], return_inverse=True)
        yield int(group[part[0]]), packed(np.diff(key[part], prepend=np.uint64(0)), narrow(local), narrow(place[part]),
                                          np.diff(oid[named], prepend=np.int64(0)), tag[named], *(m[part] for m in more))


def _sent(rows: list[tuple[int, bytes]], name: str) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + 64]], pa.int64()), pa.array([r[1] for r in rows[i:i + 64]], pa.binary())], ["group", name])


def _parse(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    for oid, tag, bounds, data, _ in _collected(batches, False):
        first, count, trigger, content = phrases(data, bounds, width)
        if not len(first):
            continue
        order = np.argsort(content, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = content[order][1:] != content[order][:-1]
        doc = np.searchsorted(bounds, first, side="right") - 1
        place = first - bounds[doc]
        rows = []
        again = np.sort(order[~new])
        if len(again):
            rows.append((-1 - int(oid[0] & 0xFFFF), packed(oid[doc[again]], tag[doc[again]], place[again].astype(np.uint32), count[again].astype(np.uint16))))
        kept = order[new]
        kept = kept[np.argsort(trigger[kept], kind="stable")]
        # a trigger is the smallest of many hashes: its own leading bits are nearly always zero
        group = (mixed(trigger[kept]) >> np.uint64(64 - bits)).astype(np.int64)
        rows += _grouped(group, doc[kept], oid, tag, trigger[kept], place[kept], content[kept], count[kept].astype(np.uint16))
        yield from _sent(rows, "phrases")


ENTRIES = "m_oid long, m_tag string, whole binary, open binary"


def _entries(key: tuple, table: pa.Table) -> pa.Table:
    """One row per document with its (first window, windows) pairs: of phrases to go whole, and of open ones."""
    oid, tag, (place, count, is_open), heads = gathered(table)
    pairs, is_open = np.stack([place, count], axis=1).astype("<u4"), is_open == 1
    whole, opened = [], []
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(oid)]):
        o = is_open[a:b]
        whole.append(pairs[a:b][~o].tobytes() or None)
        opened.append(pairs[a:b][o].tobytes() or None)
    return pa.table({"m_oid": pa.array(oid[heads], pa.int64()), "m_tag": pa.array(tag[heads].astype(str), pa.string()), "whole": pa.array(whole, pa.binary()), "open": pa.array(opened, pa.binary())})


def _dictionary(key: tuple, table: pa.Table, bits: int) -> pa.Table:
    """Of one group, the phrases that repeat an earlier one whole, and the entries that share their trigger."""
    blobs = [unpacked(b) for b in table.column("phrases").to_pylist()]
    if key[0].as_py() < 0:
        oid, tag, place, count = (np.concatenate(x) for x in zip(*blobs))
        return dealt(oid, tag, bits, place, count, np.zeros(len(oid), np.uint8))
    trigger = np.concatenate([np.cumsum(b[0]) for b in blobs])
    oid, tag = np.concatenate([np.cumsum(b[3])[b[1]] for b in blobs]), np.concatenate([b[4][b[1]] for b in blobs])
    place = np.concatenate([b[2].astype(np.int64) for b in blobs])
    content, count = np.concatenate([b[5] for b in blobs]), np.concatenate([b[6].astype(np.int64) for b in blobs])
    order = np.argsort(trigger, kind="stable")
    same = trigger[order][1:] == trigger[order][:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    at = order[shared]  # a trigger that stands alone is settled
    at = at[np.lexsort((place[at], tag[at], oid[at], content[at], trigger[at]))]
    trigger, content, oid, tag, place, count = (x[at] for x in (trigger, content, oid, tag, place, count))
    n = len(at)
    new_trigger, new_entry = np.ones(n, bool), np.ones(n, bool)
    new_trigger[1:] = trigger[1:] != trigger[:-1]
    new_entry[1:] = new_trigger[1:] | (content[1:] != content[:-1])
    family = np.cumsum(new_trigger) - 1
    several = np.bincount(family, new_entry)[family] > 1 if n else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new_entry, np.arange(n), 0))
    again = (oid != oid[first]) | (tag != tag[first]) | (place != place[first])
    take = again | (new_entry & several)
    return dealt(oid[take], tag[take], bits, place[take], count[take], (~again[take]).astype(np.uint8))


def _spread(pairs: np.ndarray) -> np.ndarray:
    """All window starts of (first, count) pairs."""
    first, count = pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64)
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _pairs(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(blob or b"", "<u4").reshape(-1, 2)


def _suffixes(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Per block the earliest of equal suffixes of open entries; the others under negative groups."""
    for oid, tag, bounds, data, opened in _collected(batches, True):
        starts = [_spread(_pairs(o)) for o in opened]
        doc = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
        place = np.concatenate(starts)
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        at = bounds[doc] + place
        content = Substrings(data).of(at, at + width)
        order = np.argsort(content, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = content[order][1:] != content[order][:-1]
        again, kept = np.sort(order[~new]), order[new]
        rows = []
        if len(again):
            rows.append((-1 - int(oid[0] & 0xFFFF), packed(oid[doc[again]], tag[doc[again]], place[again].astype(np.uint32))))
        if len(kept):
            group = (content[kept] >> np.uint64(64 - bits)).astype(np.int64)
            rows += _grouped(group, doc[kept], oid, tag, content[kept], place[kept])
        yield from _sent(rows, "leaves")


def _removed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for part in (s for batch in batches for s in slices(batch, 1)):
        data, bounds = text_bytes(part.column(1))
        sizes, gone_counts, spans, digests, kept_texts = [], [], [], [], []
        for a, b, whole, starts in zip(bounds[:-1].tolist(), bounds[1:].tolist(), part.column(2).to_pylist(), part.column(3).to_pylist()):
            text, pairs = data[a:b], _pairs(whole)
            single = np.frombuffer(starts or b"", "<u4").astype(np.int64)
            if len(pairs) or len(single):
                step = np.zeros(len(text) + 1, np.int64)
                np.add.at(step, np.concatenate([pairs[:, 0].astype(np.int64), single]), 1)
                np.add.at(step, np.concatenate([pairs.astype(np.int64).sum(1) - 1, single]) + width, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept = text[~gone].tobytes()
            else:
                spans.append(0)
                kept = text.tobytes()
            sizes.append(len(text))
            gone_counts.append(len(text) - len(kept))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(x, pa.int64()) for x in (sizes, gone_counts, spans)), pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, width: int = 100, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left).

    A byte goes when a ``width``-byte string over it also starts earlier: in a smaller doc_id (null ids
    last), or earlier in the same document. Rows with the same id and another text are ordered by the md5
    of the text; rows equal in id and text are one document and get equal results. Null texts are empty.
    Documents shorter than a window lose nothing. Other columns are ignored; an empty table gives no rows.
    Two different strings in one group are taken for equal with a chance of about 2**-64.
    """
    if width < 2 * TRIGGER:
        raise ValueError(f"a window needs at least {2 * TRIGGER} bytes")
    rows = named_apart(numbered(docs, id_col, text_col))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    # about 2 phrases per (width - TRIGGER + 2) bytes, in groups of equal hash ranges
    bits = max(4, (2 * size // (width - TRIGGER + 2) // group).bit_length())
    texts = rows.select("oid", "tag", "text")
    parsed = texts.mapInArrow(partial(_parse, width=width, bits=bits), "group long, phrases binary")
    settled = parsed.groupBy("group").applyInArrow(lambda key, table: _dictionary(key, table, bits), RECORDS)
    entries = written(settled.groupBy("bucket").applyInArrow(_entries, ENTRIES), "phrases")
    own = (F.col("oid") == F.col("m_oid")) & (F.col("tag") == F.col("m_tag"))
    opened = entries.where("open IS NOT NULL").select("m_oid", "m_tag", "open")
    suffixes = texts.join(opened, own).select("oid", "tag", "text", "open").mapInArrow(
        partial(_suffixes, width=width, bits=bits), "group long, leaves binary")
    single = marks(suffixes, bits).select(F.col("m_oid").alias("s_oid"), F.col("m_tag").alias("s_tag"), "starts")
    found = (entries.select("m_oid", "m_tag", "whole").join(single, (F.col("m_oid") == F.col("s_oid")) & (F.col("m_tag") == F.col("s_tag")), "left"))
    joined = rows.join(found, own, "left")
    return joined.select("doc_id", "text", "whole", "starts").mapInArrow(
        partial(_removed, width=width), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
