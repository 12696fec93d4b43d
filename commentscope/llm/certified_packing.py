"""Best-fit-decreasing packing with bin counts certified by dual-feasible functions.

A document longer than a sequence is cut into full pieces, each a sequence of its own, and a rest. The rests
of a task are packed in blocks, best fit decreasing. A dual-feasible function f maps shares of a sequence to
[0, 1] so that shares that fit into one sequence have images that do; the sum of the images is therefore a
lower bound for the number of sequences, and a block whose count equals its bound is certified.

Blocks exchange documents while all blocks together use more sequences than the bound over all lengths asks
for. In the first round a block with a gap gives the documents of all sequences that are not full, a certified
one those of its emptiest sequence; in the second all give those of sequences that are not full, in the third
all. What is given is packed again, best fit decreasing, and the new sequences replace the old ones if they are
fewer.

Documents of one length are interchangeable, so both packings work on the number of documents per length: a
plan is a short list of runs of equal lengths, whatever the number of documents, and a document finds its
place by its number among those of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.llm.common import quoted, slices, text_or_empty, written
from commentscope.llm.word_tokens import encode_words

#: Rests that a task packs at a time; bounds its memory.
BLOCK = 200_000
#: Functions u_k are tried for k up to this.
MOST_K = 100

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, home long, bin long, offset long, "
          "round int, ord long, bins long, bound long")
_KINDS = {"piece": pa.int32(), "round": pa.int32()}
#: Rounds of exchange, and the mark of a full piece, which is never given.
ROUNDS, NEVER = 3, 9
_FIELDS = [f.split()[0] for f in PIECES.split(", ")]


class Run(NamedTuple):
    """Items ``first`` to ``last`` (exclusive) of one length, ``each`` in a bin from ``bin`` on, at ``offset``."""
    length: int
    first: int
    last: int
    each: int
    bin: int
    offset: int


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> tuple[list[Run], int]:
    """Pack ``counts[n]`` items of each length n; the runs by falling length, and the number of bins.

    The tightest bin with room takes the next item. It stays the tightest until the length fits no more, so
    bins of equal room are filled together, each with as many items as fit.
    """
    runs, bins = [], 0
    rooms: list[int] = []  # rooms of open bins, ascending
    held: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, number of bins)

    def keep(room: int, first: int, n: int) -> None:
        if room:
            if room not in held:
                held[room] = []
                insort(rooms, room)
            held[room].append((first, n))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left, at = int(counts[length]), 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, n = held[room].pop()
                if not held[room]:
                    del held[room], rooms[i]
            else:
                room, first = capacity, bins
                n = -(-left // (capacity // length))
                bins += n
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append(Run(length, at, at + full * each, each, first, capacity - room))
                keep(room - each * length, first, full)
                at, left = at + full * each, left - full * each
            if full < n and left and left < each:
                runs.append(Run(length, at, at + left, left, first + full, capacity - room))
                keep(room - left * length, first + full, 1)
                left, full = 0, full + 1
            if full < n:
                keep(room, first + full, n - full)
    return runs, bins


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The largest bound from two families of dual-feasible functions, in whole numbers.

    ``f_t`` takes a length over ``capacity - t`` for a whole bin and one under t for nothing. ``u_k`` rounds
    (k + 1) lengths down to whole bins, divided by k, and keeps a length for which this is exact.
    """
    x = np.flatnonzero(counts)
    if not len(x):
        return 0
    n = counts[x].astype(np.int64)
    upto, mass = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * x)])
    t = np.arange(capacity // 2 + 1)
    low, high = np.searchsorted(x, t), np.searchsorted(x, capacity - t, side="right")
    best = int((upto[-1] - upto[high] - (-(mass[high] - mass[low]) // capacity)).max())
    for k in range(1, MOST_K + 1):
        scaled = (k + 1) * x
        image = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)
        best = max(best, -(-int((n * image).sum()) // (k * capacity)))
    return best


def _places(runs: list[Run]) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item, in the order of the runs."""
    at = [np.arange(r.last - r.first) for r in runs]
    return (np.concatenate([r.bin + a // r.each for r, a in zip(runs, at)]),
            np.concatenate([r.offset + a % r.each * r.length for r, a in zip(runs, at)]))


def _packed_block(rests: list[tuple], home: int, capacity: int, first_bin: int) -> pa.RecordBatch:
    """The rests of a block with their places, and the round of exchange in which the block gives each."""
    lengths = np.array([r[3] for r in rests])
    counts = np.bincount(lengths, minlength=capacity + 1)
    runs, bins = best_fit_decreasing(counts, capacity)
    bound = lower_bound(counts, capacity)
    order = np.argsort(-lengths, kind="stable")
    bin_, offset = _places(runs)
    load = np.bincount(bin_, weights=lengths[order], minlength=bins).astype(np.int64)
    giving = np.where(load < capacity, 0 if bins > bound else 1, 2)
    giving[load.argmin()] = 0 if load.min() < capacity else 2
    round_ = giving[bin_]
    # the number of a document among those of its length; those given early come first
    place = np.lexsort((round_, -lengths[order]))
    sorted_lengths = lengths[order]
    new = np.r_[True, sorted_lengths[1:] != sorted_lengths[:-1]]
    ord_ = np.empty(len(rests), np.int64)
    ord_[place] = np.arange(len(rests)) - np.maximum.accumulate(np.where(new, np.arange(len(rests)), 0))
    columns = list(zip(*(rests[i] for i in order.tolist())))
    n = len(rests)
    return _batch(*columns, np.full(n, home), first_bin + bin_, offset, round_, ord_, np.full(n, bins), np.full(n, bound))


def _batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS.get(f, pa.int64())) for f, c in zip(_FIELDS, columns)], _FIELDS)


def _pack(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    part, block = TaskContext.get().partitionId(), 0
    rests: list[tuple] = []
    used = 0  # sequences of the block that hold one full piece
    for batch in (s for whole in batches for s in slices(whole, 1)):
        full = []
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encode_words(batch.column("text").to_pylist(), vocabulary)):
            wide = np.append(ids, np.array(end_id, ids.dtype)).astype("<u4")
            for piece, start in enumerate(range(0, len(wide), capacity)):
                own = wide[start:start + capacity]
                row = (doc, piece, start, len(own), zlib.crc32(own.tobytes()))
                if len(own) == capacity:
                    full.append((*row, part << 11 | block, used, 0, NEVER, 0, 0, 0))
                    used += 1
                else:
                    rests.append(row)
        if full:
            yield _batch(*zip(*full))
        if len(rests) >= BLOCK:
            yield _packed_block(rests, part << 11 | block, capacity, used)
            rests, used, block = [], 0, block + 1
    if rests:
        yield _packed_block(rests, part << 11 | block, capacity, used)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every id of every document (end id included) in exactly one piece of one sequence, with its place there.

    ``n_sequences`` is the number of all sequences and ``lower_bound`` the bound for it: where they are equal no
    packing under these rules has fewer. Only documents longer than a sequence are cut. Null texts are empty:
    their piece is the end id alone. Null and repeated ids are kept as they are; every row is a document of its
    own, so are repeated rows. Lengths that tie go by the order of their task. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    # written once: a document is numbered where its task packed it, and never again
    pieces = written(rows.mapInArrow(partial(_pack, vocabulary=vocabulary, end_id=end_id, capacity=capacity), PIECES), "packed-blocks")
    blocks = pieces.where(F.col("length") < capacity).groupBy("home").agg(F.max("bins").alias("bins"))
    whole, total = pieces.where(F.col("length") == capacity).count(), blocks.agg(F.sum("bins")).head()[0] or 0
    counts = _counts(pieces.where(F.col("length") < capacity), capacity)
    bound = lower_bound(counts, capacity)
    sequence = F.shiftleft("home", 31) + F.col("bin")
    place = pieces.withColumn("sequence_id", sequence)
    best = total
    for round_ in range(ROUNDS):
        if best <= bound:
            break
        given = F.col("round") <= round_
        old = pieces.where(given).select("home", "bin").distinct().count()
        runs, new = best_fit_decreasing(_counts(pieces.where(given), capacity), capacity)
        if total - old + new < best:
            best = total - old + new
            place = _exchanged(pieces.withColumn("sequence_id", sequence), given, runs)
    return place.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                        F.lit(whole + best).cast("long").alias("n_sequences"), F.lit(whole + bound).cast("long").alias("lower_bound"))


def _counts(pieces: DataFrame, capacity: int) -> np.ndarray:
    """The number of pieces of each length: at most ``capacity`` numbers, whatever the number of documents."""
    out = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        out[r["length"]] = r["count"]
    return out


def _exchanged(place: DataFrame, is_given: Column, runs: list[Run]) -> DataFrame:
    """The given documents in the sequences of the new plan, which have negative numbers."""
    spark = place.sparkSession
    given = place.where(is_given)
    # a document's number among all given ones of its length: those of earlier blocks come first
    per_block = given.groupBy("home", "length").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("length").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.select("home", "length", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"))
    by_length: dict[int, list[tuple]] = {}
    for r in runs:
        by_length.setdefault(r.length, []).append((r.first, r.last, r.each, r.bin, r.offset))
    # one row per length: the plan does not grow with the documents
    plan = spark.createDataFrame(list(by_length.items()), "length long, __runs array<struct<first: long, last: long, each: long, bin: long, offset: long>>")
    at = F.col("ord") + F.col("__base")
    found = (given.join(base, ["home", "length"]).withColumn("__at", at).join(F.broadcast(plan), "length")
             .withColumn("__run", F.element_at(F.filter("__runs", lambda r: (r["first"] <= F.col("__at")) & (F.col("__at") < r["last"])), 1)))
    item = F.col("__at") - F.col("__run.first")
    moved = found.withColumn("sequence_id", -1 - F.col("__run.bin") - F.floor(item / F.col("__run.each"))).withColumn(
        "offset", F.col("__run.offset") + item % F.col("__run.each") * F.col("length"))
    return place.where(~is_given).unionByName(moved.select(*place.columns))
