"""Whitening of vectors by spectrum slicing.

The covariance is summed on the executors over centred vectors; the driver sees one matrix of the vectors'
dimension, whatever the number of rows. The number of eigenvalues below a shift s is the number of negative
pivots in an LDL^T decomposition of the covariance minus s (Sylvester's law of inertia). Halving an interval
until such counts leave one eigenvalue in it isolates each of the leading ones; inverse iteration at the
interval's middle and Rayleigh quotient iteration, which converges cubically, give the eigenpair; counts on both
sides of it then certify its number. Eigenvalues that no shift of double precision parts are one cluster:
orthonormal vectors of their common space are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.llm.common import quoted
from commentscope.plans.moments import matrix

SCALE, OFFSET = 64, 1_000_000
#: The largest component of an entry that still has a whole number in a long.
_MOST = 2.0 ** 56
_EPS = float(np.finfo(float).eps)

ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- eigenpairs of a symmetric matrix ------------------------------------------------------

def below(a: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of a symmetric matrix below ``shift``: negative pivots of an LDL^T decomposition
    of ``a - shift`` with pivots of size one and two, the largest entry first. A pivot of zero counts as positive."""
    m = a - shift * np.eye(len(a))
    negative = 0
    while len(m):
        diagonal = np.abs(np.diag(m))
        i = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diag(m)))
        p, q = np.unravel_index(off.argmax(), off.shape)
        if off[p, q] == 0 and diagonal[i] == 0:
            break
        # a single pivot unless an entry off the diagonal is far larger
        own = [i] if diagonal[i] >= 0.6403882032022076 * off[p, q] else [int(p), int(q)]
        rest = np.setdiff1d(np.arange(len(m)), own)
        pivot, side = m[np.ix_(own, own)], m[np.ix_(rest, own)]
        if len(own) == 1:
            negative += pivot[0, 0] < 0
        else:
            determinant = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] * pivot[1, 0]
            negative += 1 if determinant < 0 else 2 * int(pivot[0, 0] + pivot[1, 1] < 0)
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        m = (m + m.T) / 2
    return int(negative)


def _isolated(a: np.ndarray, first: int, last: int, low: float, high: float, least: float) -> list[tuple[int, int, float, float]]:
    """(first, last, low, high): intervals that hold the eigenvalues of these numbers (from 1, falling), one each
    where halving can part them down to the width ``least``."""
    n = len(a)
    out, open_ = [], [(1, n, low, high)]
    while open_:
        k, m, lo, hi = open_.pop()
        if k > last or m < first:
            continue
        if k == m or hi - lo <= least:
            out.append((k, m, lo, hi))
            continue
        middle = (lo + hi) / 2
        upper = n - below(a, middle)  # eigenvalues at or above the middle
        if upper >= k:
            open_.append((k, min(m, upper), middle, hi))
        if upper < m:
            open_.append((max(k, upper + 1), m, lo, middle))
    return sorted(out)


def _solved(a: np.ndarray, shift: float, v: np.ndarray) -> np.ndarray:
    """One step of inverse iteration; a shift that meets an eigenvalue exactly is moved by a rounding error."""
    while True:
        try:
            w = np.linalg.solve(a - shift * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            w = np.full(len(a), np.inf)
        size = np.linalg.norm(w)
        if np.isfinite(size) and size > 0:
            return w / size
        shift += 4 * _EPS * max(np.abs(a).max(), abs(shift), np.finfo(float).tiny)


def eigenpairs(a: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``leading`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    n = len(a)
    leading = min(leading, n)
    size = float(np.abs(a).sum(axis=1).max()) if n else 0.0
    if size == 0:
        return np.zeros(leading), np.eye(n)[:, :leading]
    least = 8 * n * _EPS * size
    draw = np.random.default_rng(0)
    values, vectors = np.zeros(n), np.zeros((n, n))
    queue = _isolated(a, 1, leading, -size * 1.01, size * 1.01, least)
    found = 0
    while queue:
        k, m, lo, hi = queue.pop(0)
        for number in range(k, min(m, leading) + 1):
            v = draw.normal(size=n)
            shift, value = (lo + hi) / 2, None
            for step in range(50):
                # a vector of a cluster, or of a value close to others, stays clear of those found before
                v = v - vectors[:, :found] @ (vectors[:, :found].T @ v)
                v = _solved(a, shift, v / np.linalg.norm(v))
                v = v - vectors[:, :found] @ (vectors[:, :found].T @ v)
                v /= np.linalg.norm(v)
                value = float(v @ a @ v)
                if np.linalg.norm(a @ v - value * v) <= 4 * n * _EPS * size:
                    break
                if lo <= value <= hi and step:
                    shift = value  # the Rayleigh quotient, once it is in the interval
            values[found], vectors[:, found] = value, v
            if k == m and hi - lo > least and not _certified(a, value, number, least):
                # the iteration went to a neighbour: halve its interval until it cannot
                middle = (lo + hi) / 2
                queue.insert(0, (k, m, middle, hi) if n - below(a, middle) >= k else (k, m, lo, middle))
                break
            found += 1
    order = np.argsort(-values[:found], kind="stable")
    return values[order], vectors[:, order]


def _certified(a: np.ndarray, value: float, number: int, least: float) -> bool:
    """Whether counts on both sides of a value say that it is eigenvalue ``number``, counted from the largest."""
    n = len(a)
    return n - below(a, value + least) < number <= n - below(a, value - least)


# ---- vectors ---------------------------------------------------------------------------------

def _whole(column: pa.Array, width: int) -> np.ndarray:
    return np.floor(SCALE * matrix(column, width)).astype(np.int64) + OFFSET


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, np.zeros(width, object)
    for batch in batches:
        x = _whole(batch.column("v"), width)
        n += len(x)
        small = len(x) * np.abs(x).max(initial=0).astype(float) < 2.0 ** 62
        total = total + (x if small else x.astype(object)).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "s": [str(int(t)) for t in total]})


def _products(batches: Iterator[pa.RecordBatch], mean: tuple[list[int], list[float]], map_: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The task's sum of products of centred vectors, mapped to components first where a map is given, with the
    sums themselves as one more row."""
    base, fraction = np.array(mean[0]), np.array(mean[1])
    held = None
    for batch in batches:
        z = (_whole(batch.column("v"), len(base)) - base) - fraction
        if map_ is not None:
            z = z @ map_
        part = np.vstack([z.T @ z, z.sum(axis=0)])
        held = part if held is None else held + part
    if held is not None:
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(held)), pa.int32()), "p": list(held)})


def _added(products: DataFrame, n: int, width: int) -> np.ndarray:
    """The covariance from the tasks' sums; divisor n, centred again by what rounding left of the means."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    added = products.groupBy("at").agg(Summarizer.sum(array_to_vector("p")).alias("p")).select("at", vector_to_array("p").alias("p"))
    out = np.zeros((width + 1, width))
    for r in added.collect():  # one row per dimension
        out[r["at"]] = r["p"]
    mean = out[-1] / n
    return out[:-1] / n - np.outer(mean, mean)


def _rows(batches: Iterator[pa.RecordBatch], n: int, total: list[int], mean: tuple[list[int], list[float]], map_: np.ndarray,
          good: np.ndarray, explained: np.ndarray, identity_error: float) -> Iterator[pa.RecordBatch]:
    base, fraction, s = np.array(mean[0]), np.array(mean[1]), np.array(total, object)
    k = map_.shape[1]
    for whole in batches:
        for batch in (whole.slice(i, 1024) for i in range(0, len(whole), 1024)):
            x = _whole(batch.column("v"), len(base))
            z = ((x - base) - fraction) @ map_
            off = np.abs(x - base).max(initial=0).astype(float) + 1
            if n * off * n * off * len(base) < 2.0 ** 62:
                # n * x - S, in longs: n * (x - base) - (S - n * base)
                left = (s - n * base.astype(object)).astype(np.int64)
                deviation = ((n * (x - base) - left) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum(int(v) ** 2 for v in row) for row in n * x.astype(object) - s]
            deviation = [v if v < 2 ** 63 else None for v in deviation]
            ids = batch.column("vec_id")
            each = np.repeat(np.arange(len(batch)), k)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))), pa.array(np.full(len(each), n)),
                 pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array(z.reshape(-1), mask=np.tile(~good, len(batch))),
                 pa.array(np.tile(explained, len(batch))), pa.array(np.full(len(each), identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(vectors: DataFrame, leading: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and leading component: the vector's entries as whole numbers ``floor(64 * c) + 1000000``,
    centred, projected on the component and divided by its deviation.

    Left out are null vectors and those that hold a null or non-finite entry or one of over 2^56 / 64 (it has no
    exact whole number), and vectors of another length than the most frequent one (ties: the longest), which have
    no covariance with the others; empty vectors too. Null and repeated ids and repeated rows are kept and count
    each. A component whose eigenvalue is zero to double precision has a null ``whitened`` and does not enter
    ``identity_error``. Tied eigenvalues have any orthonormal vectors of their space. A ``deviation`` that no long
    holds is null. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    v = F.col("v")
    rows = vectors.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), F.col(quoted(vector_col)).cast("array<double>").alias("v"))
    known: Column = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) < _MOST / SCALE, F.lit(False)))
    rows = rows.where(known)
    most = rows.groupBy(F.size(v).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).head()
    if most is None:
        return vectors.sparkSession.createDataFrame([], ROWS)
    width, n = most["width"], most["count"]
    rows = rows.where(F.size(v) == width)
    sums = rows.mapInArrow(partial(_sums, width=width), "at int, n long, s string").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    total = [int(r["s"]) for r in sums.orderBy("at").collect()]  # one row per dimension
    mean = [s // n for s in total], [s % n / n for s in total]
    products = "at int, p array<double>"
    covariance = _added(rows.mapInArrow(partial(_products, mean=mean, map_=None), products), n, width)
    values, components = eigenpairs(covariance, leading)
    good = values > 16 * width * _EPS * max(float(np.trace(covariance)), np.finfo(float).tiny)
    map_ = components / np.sqrt(np.where(good, values, 1.0))
    check = _added(rows.mapInArrow(partial(_products, mean=mean, map_=map_), products), n, len(values))
    identity_error = float(np.abs(check[np.ix_(good, good)] - np.eye(good.sum())).max(initial=0.0))
    trace = float(np.trace(covariance))
    explained = np.where(values > 0, values, 0.0) / trace if trace > 0 else np.zeros(len(values))
    return rows.mapInArrow(partial(_rows, n=n, total=total, mean=mean, map_=map_, good=good, explained=explained, identity_error=identity_error), ROWS)
