"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is embedded as the bit counts of its 32 segments of two bits. The Manhattan distance of
two count vectors is a lower bound of the number of differing bits, so a range join of the count
vectors on a grid finds every pair of near fingerprints. The grid's cells are the exact counts on some
of the axes: vectors within a radius of 4 that are split into g groups of axes agree on at least g - 4
whole groups, and every choice of g - 4 groups is a set of cells. Pairs that meet in a cell are held
against the Manhattan bound, then against the exact number of differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentscope.llm.common import mixed, numbered, slices, written
from commentscope.llm.components import components

_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bit i is set when it is set in over half the XXH64 values of all shingles, repeats included."""
    words = text.translate(_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, stops)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    on = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(on, bitorder="little").view("<u8")[0])


# ---- links between fingerprints --------------------------------------------------------------

_LOW = np.uint64(0x5555555555555555)
SEGMENTS = 32


def embedded(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, each count in unary in its own two bits.

    The Manhattan distance of two count vectors is the number of differing bits of these words. It
    never exceeds the number of differing bits of the fingerprints.
    """
    high = fp >> np.uint64(1)
    return ((fp | high) & _LOW) | (((fp & high) & _LOW) << np.uint64(1))


def plan_cells(distinct: int, radius: int) -> list[tuple[int, ...]]:
    """The axis groups whose cells are joined. With g groups of segments, counts within the radius agree
    on at least ``g - radius`` whole groups; g is chosen for the fewest comparisons expected."""
    def cost(g: int) -> float:
        bits = 1.5 * SEGMENTS * (g - radius) / g
        return comb(g, radius) * (1 + max(distinct, 1) / 2**bits)
    g = min(range(radius + 1, min(radius + 8, SEGMENTS) + 1), key=cost)
    return list(combinations(range(g), g - radius))


def _masks(groups: int) -> np.ndarray:
    """The bits of each group of segments."""
    out = []
    for part in np.array_split(np.arange(SEGMENTS), groups):
        mask = 0
        for j in part.tolist():
            mask |= 3 << (2 * j)
        out.append(mask)
    return np.array(out, np.uint64)


def _cells(batches: Iterator[pa.RecordBatch], cells: list[tuple[int, ...]], groups: int) -> Iterator[pa.RecordBatch]:
    masks = _masks(groups)
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        counts = embedded(fp)
        for c, axes in enumerate(cells):
            mask = np.bitwise_or.reduce(masks[list(axes)])
            key = mixed((counts & mask) ^ mixed(np.full(1, c + 1, np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(fp), c, np.int32)), pa.array(fp.view(np.int64))], ["key", "cell", "fp"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs, those that a union by pairs needs: the same components from fewer links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep.append(i)
    return a[keep], b[keep]


def _linked_runs(key: np.ndarray, cell: np.ndarray, fp: np.ndarray, cells: list[tuple[int, ...]], groups: int, radius: int):
    """Links inside runs of equal keys, each pair from the first cell that both share."""
    masks, counts = _masks(groups), embedded(fp)
    out_a, out_b = [], []
    alive, d = np.arange(len(key) - 1), 1
    while len(alive):
        alive = alive[alive + d < len(key)]
        alive = alive[key[alive] == key[alive + d]]
        i, j = alive, alive + d
        apart = counts[i] ^ counts[j]
        near = np.bitwise_count(apart) <= radius
        near &= np.bitwise_count(fp[i] ^ fp[j]) <= radius
        i, j, apart = i[near], j[near], apart[near]
        if len(i):
            agree = (apart[:, None] & masks[None, :]) == 0
            order = np.cumsum(agree, axis=1)
            agree &= order <= groups - radius
            first = agree @ (1 << np.arange(groups))
            own = np.array([sum(1 << g for g in axes) for axes in cells])[cell[i]]
            i, j = i[first == own], j[first == own]
            a, b = (_forest(fp[i], fp[j]) if len(i) > 4096 else (fp[i], fp[j]))
            out_a.append(a)
            out_b.append(b)
        d += 1
    a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (out_a, out_b))
    return _forest(a, b) if len(a) > len(key) // 2 else (a, b)


def _links(batches: Iterator[pa.RecordBatch], cells: list[tuple[int, ...]], groups: int, radius: int) -> Iterator[pa.RecordBatch]:
    """Rows come in order of key; a run that a batch cuts is carried to the next one."""
    held: list[np.ndarray] | None = None
    for batch in _with_end(batches):
        if batch is None:
            now = held
        else:
            new = [batch.column("key").to_numpy(zero_copy_only=False), batch.column("cell").to_numpy(zero_copy_only=False),
                   batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)]
            now = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            cut = np.searchsorted(now[0], now[0][-1]) if len(now[0]) else 0
            now, held = [x[:cut] for x in now], [x[cut:] for x in now]
        if now is not None and len(now[0]) > 1:
            a, b = _linked_runs(*now, cells, groups, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _prints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for part in (s for batch in batches for s in slices(batch, 1)):
        texts = part.column(1).cast(pa.large_binary()).to_pylist()
        fp = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64)), part.column(2)], ["doc_id", "fp", "tag"])


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint, fp (the same as a signed number), tag (the md5 of the text),
    class (the component's smallest fp), component_id.

    A null or empty text has fingerprint zero and is linked like any other. The component id is the
    smallest doc_id that is reached over links; null ids never are, and a component of null ids alone
    has a null id. Repeated rows have equal rows in the result. Other columns are ignored.
    Work on links starts from distinct fingerprints, so copies cost one row, however many they are.
    """
    rows = numbered(docs, id_col, text_col).select("doc_id", "text", "tag")
    prints = written(rows.mapInArrow(partial(_prints, shingle=shingle, seed=seed), "doc_id long, fp long, tag string"), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    cells = plan_cells(distinct.count(), radius)
    groups = radius + len(cells[0])
    # every run of equal cells streams through a task in order: memory is one cell and one batch
    celled = (distinct.select("fp").mapInArrow(partial(_cells, cells=cells, groups=groups), "key long, cell int, fp long")
              .repartition("key").sortWithinPartitions("key"))
    links = celled.mapInArrow(partial(_links, cells=cells, groups=groups, radius=radius), "u long, v long")
    roots = components(links)
    ids = (distinct.join(roots, distinct["fp"] == roots["node"]).groupBy("root").agg(F.min("first_id").alias("component_id")))
    linked = roots.join(ids, "root").select("node", "root", "component_id")
    known = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        F.col("fp").alias("k_fp"), F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("class"))
    out = prints.join(known, prints["fp"] == known["k_fp"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "fp", "tag", "class", "component_id")


def representatives(found: DataFrame) -> DataFrame:
    """(oid, tag) of the one row that stays of each class of ``near_duplicates``: that of the smallest
    doc_id (null ids last), of these the smallest fingerprint and md5 of the text."""
    oid = F.coalesce("doc_id", F.lit(2**63 - 1))
    return found.groupBy("class").agg(F.min(F.struct(oid.alias("oid"), "fp", "tag")).alias("first")).select("first.oid", "first.tag")
