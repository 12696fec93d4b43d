"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of several tables hashes a vector x to the cell ``floor((a_j . x + b_j) / width)`` over its random
directions. A query visits its own cell and, in order of estimated success (the sum of squared distances
to the crossed cell walls), neighbouring cells. What all tables give is ranked by exact distance.

Width and number of probes are fitted on a bounded sample until it reaches a recall there; among all
rows neighbours are nearer than in the sample, so the probes find them more easily. Every row is indexed.

Rows with one and the same vector are one entry with their smallest ids: more can never be in a result.
Cells are dealt to groups by a hash; a cell with more than ``GROUP`` entries is split over several groups,
all of which its queries visit, so no cell is cut and no group is unbounded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentscope.llm.common import bounded_sample, mixed, quoted, written

#: Rows of the fitting sample, at most: those with the smallest hashes of their ids.
SAMPLE = 2_000
TABLES, DIRECTIONS = 8, 10
PROBES = (25, 50, 100, 200, 400)
RECALL = 0.97
#: Index entries of a group, about.
GROUP = 100_000
#: Queries that the exact pass takes at a time.
LEFT_OVER = 1_000


def templates(directions: int, most: int) -> np.ndarray:
    """Sets of wall crossings in order of expected cost, as rows of 0/1 over the sorted walls; the first is
    empty. Wall 2m+1-j is the other side of the direction of wall j: no set holds both."""
    n, m = 2 * directions, directions
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (n + 1 - j) / (m + 1) + (n + 1 - j) * (n + 2 - j) / (4 * (m + 1) * (m + 2))
            for j in range(1, n + 1)]
    heap, out = [(cost[0], (0,))], [()]
    while heap and len(out) < most:
        c, walls = heapq.heappop(heap)
        if len({min(w, n - 1 - w) for w in walls}) == len(walls):
            out.append(walls)
        last = walls[-1]
        if last + 1 < n:
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], (*walls[:-1], last + 1)))
            heapq.heappush(heap, (c + cost[last + 1], (*walls, last + 1)))
    table = np.zeros((len(out), n))
    for i, walls in enumerate(out):
        table[i, list(walls)] = 1
    return table


@dataclass
class Hashing:
    directions: np.ndarray  # (tables, dimensions, directions)
    shifts: np.ndarray      # (tables, directions)
    width: float
    probes: int
    crossings: np.ndarray

    def _cells(self, x: np.ndarray, t: int) -> np.ndarray:
        return x @ self.directions[t] / self.width + self.shifts[t]

    @staticmethod
    def _names(cells: np.ndarray, t: int) -> np.ndarray:
        key = np.full(cells.shape[:-1], t + 1, np.uint64)
        for j in range(cells.shape[-1]):
            key = mixed(key ^ cells[..., j].astype(np.int64).view(np.uint64)) + np.uint64(j + 1)
        return mixed(key).view(np.int64)

    def entries(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables) cell names."""
        return np.stack([self._names(np.floor(self._cells(x, t)), t) for t in range(len(self.shifts))], axis=1)

    def visits(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables * probes) names of the cells that queries visit."""
        out, m = [], self.shifts.shape[1]
        for t in range(len(self.shifts)):
            at = self._cells(x, t)
            home = np.floor(at)
            low = at - home
            walls = np.concatenate([low, 1 - low], axis=1)
            order = np.argsort(walls, axis=1)
            near = np.take_along_axis(walls, order, axis=1) ** 2
            best = np.argsort(near @ self.crossings.T, axis=1, kind="stable")[:, :self.probes]
            step = np.zeros((len(x), best.shape[1], 2 * m))
            np.put_along_axis(step, np.broadcast_to(order[:, None, :], step.shape).copy(), self.crossings[best], axis=2)
            out.append(self._names(home[:, None, :] + step[..., m:] - step[..., :m], t))
        return np.concatenate(out, axis=1)


def fit(sample: np.ndarray, k: int, seed: int = 11) -> Hashing:
    """Width and probes that find ``RECALL`` of the k nearest within the sample (for at most 100 queries)."""
    n, d = sample.shape
    draw = np.random.default_rng(seed)
    directions, shifts = draw.standard_normal((TABLES, d, DIRECTIONS)), draw.random((TABLES, DIRECTIONS))
    crossings = templates(DIRECTIONS, 4 * max(PROBES))
    queries = sample[:100]
    apart = np.sqrt(np.maximum((queries**2).sum(1)[:, None] + (sample**2).sum(1) - 2 * queries @ sample.T, 0))
    apart[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    near = np.argsort(apart, axis=1)[:, :min(k, n - 1)]
    width = 1.6 * (float(np.median(np.take_along_axis(apart, near[:, -1:], 1))) if n > 1 else 1.0) or 1.0
    while True:
        for probes in PROBES:
            hashing = Hashing(directions, shifts, width, probes, crossings)
            if n < 2:
                return hashing
            own, visits = hashing.entries(sample), hashing.visits(queries)
            hits = [np.isin(own[near[i]], visits[i]).any(axis=1).mean() for i in range(len(queries))]
            if np.mean(hits) >= RECALL:
                return hashing
        width *= 1.25


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _parts(cells: np.ndarray, hot: dict[int, int]) -> np.ndarray:
    """Into how many groups each cell is split."""
    if not hot:
        return np.ones(cells.shape, np.int64)
    names = np.array(sorted(hot), np.int64)
    at = np.minimum(np.searchsorted(names, cells), len(names) - 1)
    return np.where(names[at] == cells, np.array([hot[x] for x in names.tolist()], np.int64)[at], 1)


def _group(cells: np.ndarray, part: np.ndarray, groups: int) -> np.ndarray:
    return (mixed(cells.view(np.uint64) + mixed(part.astype(np.uint64))) % np.uint64(groups)).astype(np.int64)


def _cell_names(batches: Iterator[pa.RecordBatch], hashing: Hashing) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            yield pa.RecordBatch.from_arrays([pa.array(hashing.entries(_matrix(batch.column(1))).reshape(-1))], ["cell"])


def _index(batches: Iterator[pa.RecordBatch], hashing: Hashing, groups: int, hot: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        cells = hashing.entries(_matrix(batch.column(1)))
        reps = batch.column(0).to_numpy(zero_copy_only=False)
        for t in range(cells.shape[1]):
            own = np.ascontiguousarray(cells[:, t])
            part = (mixed(reps.view(np.uint64)) % _parts(own, hot).astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_group(own, part, groups)), pa.array(own), batch.column(0), batch.column(1)], ["group", "cell", "rep", "v"])


def _probes(batches: Iterator[pa.RecordBatch], hashing: Hashing, groups: int, hot: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """A query goes to a group once, with all the cells that it visits there."""
    for whole in batches:
        for k in range(0, len(whole), 64):
            batch = whole.slice(k, 64)
            visits = hashing.visits(_matrix(batch.column(1)))
            rows, at, cells = [], [], []
            for i in range(len(batch)):
                own = np.unique(visits[i])
                parts = _parts(own, hot)
                own = np.repeat(own, parts)
                part = np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)
                group = _group(own, part, groups)
                order = np.argsort(group, kind="stable")
                for piece in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                    rows.append(int(group[piece[0]]))
                    at.append(i)
                    cells.append(own[piece])
            ids, vectors = batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), ids, vectors, pa.array(cells, pa.list_(pa.int64()))], ["group", "query_id", "v", "cells"])


FOUND = "query_id long, rep long, score double"


def _best(query: int, reps: np.ndarray, x: np.ndarray, q: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    score = np.sqrt(((x - q) ** 2).sum(axis=1))
    if len(score) > 4 * most:  # all that are as near as the last one needed, ties included
        keep = np.flatnonzero(score <= np.partition(score, most - 1)[most - 1])
        reps, score = reps[keep], score[keep]
    order = np.lexsort((reps, score))[:most]
    return np.full(len(order), query, np.int64), reps[order], score[order]


def _rank(key: tuple, index: pa.Table, probes: pa.Table, most: int) -> pa.Table:
    """The nearest entries of a group for each of its queries, by exact distance."""
    out = []
    if len(index) and len(probes):
        cell, rep = index.column("cell").to_numpy(), index.column("rep").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, rep, x = cell[order], rep[order], _matrix(index.column("v").combine_chunks())[order]
        queries = _matrix(probes.column("v").combine_chunks())
        for i, (query, own) in enumerate(zip(probes.column("query_id").to_pylist(), probes.column("cells").to_pylist())):
            own = np.array(own, np.int64)
            a, b = np.searchsorted(cell, own, "left"), np.searchsorted(cell, own, "right")
            size = b - a
            if size.sum():
                ends = np.cumsum(size)
                at = np.repeat(a - (ends - size), size) + np.arange(ends[-1])
                reps, first = np.unique(rep[at], return_index=True)  # an entry may come from several tables
                out.append(_best(query, reps, x[at[first]], queries[i], most))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table(dict(zip(("query_id", "rep", "score"), columns)))


def _exact(batches: Iterator[pa.RecordBatch], ids: list[int], queries: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """A block of queries against all entries: the nearest of each batch."""
    for batch in batches:
        if len(batch):
            reps, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            out = [_best(i, reps, x, q, most) for i, q in zip(ids, queries)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "rep", "score"])


def _nearest(found: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    # a query's best entries first, then their rows
    best = Window.partitionBy("query_id").orderBy("score", "rep")
    few = (found.distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
           .join(entries.select(F.col("rep").alias("e_rep"), "ids"), F.col("rep") == F.col("e_rep"))
           .select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows by Euclidean distance of every row whose id is divisible by ``every``.

    Null ids, null vectors, zero vectors and vectors with null or non-finite parts take no part, nor do
    vectors of another length than the most common (the shortest of these). A row with the id of the query
    is the query's own. Repeated rows are one row. A query that its probes give fewer than k rows is held
    against all rows, in blocks of queries. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    clean = (vectors.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(vector_col)).alias("v"))
             .where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
             .where(F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))).where(F.exists(v, lambda x: x != 0)))
    length = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").head()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    clean = clean.where(F.size("v") == length["n"]).select("id", F.transform("v", lambda x: x + F.lit(0).cast("float")).alias("v"))  # -0.0 is 0.0
    # of one vector the k + 1 smallest ids are enough; the limit applies before the shuffle, too
    ranked = clean.distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    entries = written(ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("rep"), "v", "ids"), "entries")
    queries = clean.where(F.col("id") % every == 0).distinct()
    sample = bounded_sample(entries.select("rep", "v"), SAMPLE, F.xxhash64("rep")).collect()
    hashing = fit(np.array([r["v"] for r in sample], float), k)
    rows = entries.select("rep", "v")
    groups = 1 + TABLES * entries.count() // GROUP
    cells = rows.mapInArrow(partial(_cell_names, hashing=hashing), "cell long").groupBy("cell").count()
    # at most tables * entries / GROUP cells are as large as this
    hot = {r["cell"]: -(-r["count"] // GROUP) for r in cells.where(F.col("count") > GROUP).collect()}
    kind = entries.schema["v"].dataType.simpleString()
    index = rows.mapInArrow(partial(_index, hashing=hashing, groups=groups, hot=hot), f"group long, cell long, rep long, v {kind}")
    probes = queries.mapInArrow(partial(_probes, hashing=hashing, groups=groups, hot=hot), f"group long, query_id long, v {kind}, cells array<long>")
    ranked = index.groupBy("group").cogroup(probes.groupBy("group")).applyInArrow(lambda key, a, b: _rank(key, a, b, k + 1), FOUND)
    result = written(_nearest(ranked, entries, k), "nearest")
    few = result.groupBy(F.col("query_id").alias("q")).count().where(F.col("count") >= k)
    left = written(queries.join(few, F.col("id") == F.col("q"), "left_anti").withColumn("h", F.xxhash64("id")), "left-over")
    count, total = left.count(), entries.count()
    blocks = -(-count // LEFT_OVER)
    for b in range(blocks):
        block = left.where(F.pmod("h", F.lit(blocks)) == b).collect()
        found = rows.mapInArrow(partial(_exact, ids=[r["id"] for r in block], queries=np.array([r["v"] for r in block], float), most=k + 1), FOUND) if block and total else None
        if found is not None:
            done = spark.createDataFrame([(r["id"],) for r in block], "q long")
            result = (result.join(F.broadcast(done), F.col("query_id") == F.col("q"), "left_anti")
                      .unionByName(written(_nearest(found, entries, k), "nearest-exact")))
    return result
