"""Cost-balanced packing of documents into sequences of a fixed token capacity.

The cost of a piece of n tokens is estimated as ``n + n * n / capacity``: the linear layers plus
attention within the piece. A task cuts its documents into whole sequences, which are full, and a
rest each. The rests of a block of documents go, from the longest down, to the sequence with the
lowest cost so far that has room for them; the block opens as few sequences as its tokens need. A rest
that no sequence has room for is cut. So a block loses less than one sequence to padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentscope.llm.common import quoted, slices, text_or_empty, written
from commentscope.llm.tokens import encode_all

#: Tokens of rests that a task balances at a time; bounds its memory, whatever the input.
BLOCK_TOKENS = 4_000_000

_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "local_sequence", "offset")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, local_sequence long, offset long"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class _Rooms:
    """Open sequences by room: for each room those that have it, cheapest first, under a tree of least costs, so
    that the cheapest sequence with enough room is found exactly."""

    def __init__(self, count: int, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.at: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]
        self.least: list[tuple[float, int] | None] = [None] * (2 * self.size)
        self.at[capacity] = [(0.0, s) for s in range(count)]
        self._settle(capacity)

    def _settle(self, room: int) -> None:
        i = room + self.size
        self.least[i] = self.at[room][0] if self.at[room] else None
        while i > 1:
            a, b, i = self.least[i & ~1], self.least[i | 1], i // 2
            self.least[i] = a if b is None or a is not None and a < b else b

    def add(self, room: int, cost: float, sequence: int) -> None:
        heapq.heappush(self.at[room], (cost, sequence))
        self._settle(room)

    def cheapest(self, room: int) -> int | None:
        """The cheapest sequence with at least this room; ties go to the first."""
        best, lo, hi = None, room + self.size, 2 * self.size
        while lo < hi:
            if lo & 1:
                best = min(filter(None, (best, self.least[lo])), default=None)
                lo += 1
            lo, hi = lo // 2, hi // 2
        return best[1] if best else None

    def take(self, room: int) -> None:
        heapq.heappop(self.at[room])
        self._settle(room)


def balance(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Place rests into the fewest sequences: (rest, start in it, length, sequence, offset) per piece.

    The longest rest goes first, to the cheapest sequence with room for the whole of it; where none has, the
    cheapest one with any room takes a part, and what is left of the rest is placed in the same way.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    count = -(-sum(lengths) // capacity)
    cost, room, out, rooms = [0.0] * count, [capacity] * count, [], _Rooms(count, capacity)
    for i in order:
        start, n = 0, lengths[i]
        while n:
            s = rooms.cheapest(n)
            if s is None:
                s = rooms.cheapest(1)
            own = min(n, room[s])
            rooms.take(room[s])
            out.append((i, start, own, s, capacity - room[s]))
            room[s] -= own
            cost[s] += own + own * own / capacity
            if room[s]:
                rooms.add(room[s], cost[s], s)
            start, n = start + own, n - own
    return out


def _pack(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    sequences, held, rests, rows = 0, 0, [], []

    def flush() -> list[tuple]:
        nonlocal sequences, held, rests
        placed = balance([len(r[3]) for r in rests], capacity)
        out = []
        for i, start, n, s, offset in placed:
            doc, total, base, ids = rests[i]
            out.append((doc, base + start, n, _crc(ids[start:start + n]), total, part, sequences + s, offset))
        sequences += -(-held // capacity)
        held, rests = 0, []
        return out

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if f == "part" else pa.int64()) for f, c in zip(_FIELDS, columns)], list(_FIELDS))

    for batch in (s for whole in batches for s in slices(whole, 1)):
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encode_all(batch.column("text").to_pylist(), vocabulary)):
            ids = np.append(ids, np.array(end_id, "<u2"))
            whole = len(ids) // capacity * capacity
            for start in range(0, whole, capacity):
                rows.append((doc, start, capacity, _crc(ids[start:start + capacity]), len(ids), part, sequences, 0))
                sequences += 1
            if whole < len(ids):
                rests.append((doc, len(ids), whole, ids[whole:]))
                held += len(ids) - whole
            if held >= BLOCK_TOKENS:
                rows += flush()
        if rows:
            yield batch_of(rows)
            rows = []
    if rests:
        yield batch_of(flush())


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every id of every document (end id included) in exactly one piece of one sequence.

    Null texts are empty: their piece is the end id alone. Null and repeated ids are kept as they
    are; every row is a document of its own. Other columns are ignored. An empty table gives no rows.
    Sequences are numbered from 0; each part's first number is the prefix sum over one row per part.
    """
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    # the pieces are written once: a sequence is numbered where it was made, and never made again
    pieces = written(rows.mapInArrow(partial(_pack, vocabulary=vocabulary, end_id=end_id, capacity=capacity), PIECES), "pieces")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (pieces.groupBy("part").agg((F.max("local_sequence") + 1).alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base")))
    # one row per part
    return pieces.join(F.broadcast(bases), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("local_sequence")).alias("sequence_id"), "offset")
