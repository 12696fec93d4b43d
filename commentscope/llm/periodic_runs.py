"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)`` words long, that no neighbouring
word extends. Periods from B to 2B - 1, B a power of two, are searched together: the text is cut into blocks of
B words, and the squared differences between a block and every place of the 2B - 1 words that begin B words
later are summed by an exact integer transform. A place of sum zero is an occurrence at a distance d from B to
2B - 1. A run of period d holds a whole block with its occurrence near its start, so each distance found is
extended to both sides, word by word, to the longest stretch of that period.

Inside a run of a small period every block occurs at many distances. Where a block and its occurrence lie in
runs of one period q <= B / 2, two cases are left aside: both in one run, since a stretch that holds both has a
period that divides q; and two runs whose ends are not d apart, since a stretch of period d that reaches beyond
the first run's end repeats that end d words later, and the block that comes first in it sees that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentscope.llm.common import quoted, slices
from commentscope.llm.ntt import PRIMES, correlation

#: Words of blocks that are transformed at a time.
CHUNK = 1 << 16

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """For each word of a document the word of the text that stands there: in a tenth of all documents, chosen
    by the CRC-32 of the id, the text from some word on repeats with some period. A null id leaves it alone."""
    place = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        place[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return place


def _occurrences(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of every block of ``width`` words and its occurrences at distances from width to
    2 * width - 1. ``ends`` holds the end of each block's document."""
    top = int(ids.max()) + 1  # stands behind the end of a document and equals no word
    needed, product = 1, PRIMES[0][0]
    while needed < len(PRIMES) and product <= width * top * top:  # sums below the product of the primes are exact
        product, needed = product * PRIMES[needed][0], needed + 1
    found = []
    rows = max(1, CHUNK // width)
    for at in range(0, len(starts), rows):
        first, end = starts[at:at + rows], ends[at:at + rows]
        block = ids[first + np.arange(width)[:, None]]
        place = first + width + np.arange(2 * width)[:, None]
        window = np.where(place < end, ids[np.minimum(place, len(ids) - 1)], np.uint64(top))
        column, zero = np.arange(len(first)), None
        for prime, generator in PRIMES[:needed]:
            p = np.uint64(prime)
            b, w = block[:, column] % p, window[:, column] % p
            squares = np.zeros((2 * width, len(column)), np.uint64)
            np.cumsum(w[:-1] * w[:-1] % p, axis=0, out=squares[1:])
            sums = squares[width:] - squares[:width] + (b * b % p).sum(axis=0)
            same = sums % p == correlation(b, w, prime, generator) * np.uint64(2) % p
            zero = same if zero is None else zero[:, hit] & same
            hit = zero.any(axis=0)
            column = column[hit]
            if not len(column):
                break
        distance, row = np.nonzero(zero[:, hit])
        found.append((first[column[row]], distance + width))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _equal_words(ids: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words from a and from b on are equal, going forward (way 1) or back (-1), at most ``room``."""
    equal, active, step = np.zeros(len(a), np.int64), np.arange(len(a)), 8
    while len(active):
        t = equal[active][:, None] + np.arange(step)
        inside = t < room[active][:, None]
        t = np.where(inside, t, 0) * way
        at, to = a[active][:, None] + t, b[active][:, None] + t
        same = inside & (ids[np.where(inside, at, 0)] == ids[np.where(inside, to, 0)])
        n = np.where(same.all(axis=1), step, same.argmin(axis=1))
        equal[active] += n
        active = active[n == step]
        step = min(2 * step, max(8, CHUNK // max(1, len(active))))
    return equal


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in texts that lie one after another in ``ids``; ``bounds`` are the
    texts' bounds. Places are those in ``ids``; rows are ordered by start, then period."""
    values = ids.astype(np.uint64)
    known = np.zeros((0, 3), np.int64)
    sizes = np.diff(bounds)
    width = 1
    while len(sizes) and sizes.max() >= max(6, 4 * width):
        texts = np.flatnonzero(sizes >= max(6, 4 * width))
        n_blocks = sizes[texts] // width - 1
        lo, hi = np.repeat(bounds[texts], n_blocks), np.repeat(bounds[texts + 1], n_blocks)
        number = np.arange(n_blocks.sum()) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        start, distance = _occurrences(values, lo + number * width, hi, width)

        small = known[(2 * known[:, 2] <= width) & (known[:, 1] - known[:, 0] >= width)]
        if len(small) and len(start):
            holder = np.full(len(ids), -1)
            n = small[:, 1] - small[:, 0] - width + 1
            holder[np.repeat(small[:, 0] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = np.repeat(np.arange(len(small)), n)
            u, v = holder[start], holder[start + distance]
            keep = (u < 0) | (v < 0) | (u != v) & (small[v, 1] - small[u, 1] == distance)
            start, distance = start[keep], distance[keep]

        if len(start):
            # neighbouring blocks with one distance are one stretch
            order = np.lexsort((start, distance))
            start, distance = start[order], distance[order]
            new = np.r_[True, (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + width)]
            head = np.flatnonzero(new)
            a, d = start[head], distance[head]
            b = start[np.r_[head[1:], len(start)] - 1] + width
            text = np.searchsorted(bounds, a, side="right") - 1
            a = a - _equal_words(values, a - 1, a - 1 + d, a - bounds[text], -1)
            b = b + d + _equal_words(values, b, b + d, bounds[text + 1] - b - d, 1)
            rows = np.stack([a, b, d], axis=1)[b - a >= np.maximum(6, 4 * d)]
            # a stretch with two periods is the run of the smaller one
            known = np.concatenate([known, rows])
            known = known[np.lexsort((known[:, 2], known[:, 1], known[:, 0]))]
            known = known[np.r_[True, (known[1:, :2] != known[:-1, :2]).any(axis=1)][:len(known)]]
        width *= 2
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def _collapse(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[pa.RecordBatch]:
    for batch in (s for whole in batches for s in slices(whole, 1)):
        doc_ids = batch.column("doc_id").to_pylist()
        texts, ids, bounds = [], [], np.zeros(len(batch) + 1, np.int64)
        for i, (doc, text) in enumerate(zip(doc_ids, batch.column("text").cast(pa.binary()).to_pylist())):
            words = text.split()
            seen: dict[bytes, int] = {}
            own = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
            if plant:
                place = planted(doc, len(words))
                words, own = [words[k] for k in place.tolist()], own[place]
            texts.append(words)
            ids.append(own)
            bounds[i + 1] = bounds[i] + len(own)
        runs = find_runs(np.concatenate(ids), bounds)
        step = np.zeros(bounds[-1] + 1, np.int64)
        np.add.at(step, runs[:, 0] + runs[:, 2], 1)
        np.add.at(step, runs[:, 1], -1)
        dropped = np.cumsum(step) > 0
        cut = np.searchsorted(runs[:, 0], bounds)
        out_runs, collapsed = [], []
        for i, words in enumerate(texts):
            own = runs[cut[i]:cut[i + 1]]
            out_runs.append([{"start": s - int(bounds[i]), "length": e - s, "period": q} for s, e, q in own.tolist()])
            gone = dropped[bounds[i]:bounds[i + 1]] if len(own) else ()
            collapsed.append(b" ".join(w for w, g in zip(words, gone) if not g) if len(own) else b" ".join(words))
        run_type = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(out_runs, run_type), pa.array(collapsed, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of every whole text, ordered by start and period, and
    its words without those that any run holds after its first period, joined by one space.

    ``plant`` repeats parts of some texts first, as ``planted`` says. A null or blank text has no words, no runs
    and an empty collapsed text. Null and repeated ids and repeated rows are kept: every row is judged by itself.
    Other columns are ignored, whatever their names. An empty table gives no rows. There is no shuffle.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(partial(_collapse, plant=plant), RUNS)


def digest(found: DataFrame) -> DataFrame:
    """One row per document: its runs counted, the longest one, and hashes of all runs and of the collapsed text."""
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    best = found.withColumn("__best", F.array_min(ranked))
    length, period = -F.col("__best.n"), F.col("__best.period")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("__best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
