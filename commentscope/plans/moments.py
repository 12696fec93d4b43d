"""Sums of products over array columns, without a row per entry.

A task turns its batches of arrays into matrices, multiplies them and keeps one matrix of sums, which it emits
at its end; the engine's vector aggregate adds the matrices of all tasks, before and after the shuffle. So the
shuffle carries one matrix per task, and no plan holds a row per entry or a window.

A matrix is cut into blocks of ``BLOCK`` by ``BLOCK`` pairs of columns, one row each; where the blocks of all
pairs would not fit into a task, they are dealt over several passes of the table.

Nulls and NaN are unknown. All sums of a pair are taken over the rows where both entries are known. Entries are
shifted by one early value of their column, so that sums of squares do not cancel; ``correlations`` repeats the
pass with the columns' means where that value lay far from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.plans.ordering import pinned

#: Columns of a block, and blocks whose sums a task keeps at a time (six matrices each, about 3 MB).
BLOCK = 256
BLOCKS = 64
#: Rows that are looked at for the shift.
EARLY = 64

MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")
SUMS = "a int, b int, sums array<double>"
#: A column whose variance is this small beside its mean square was shifted badly, or holds one value only.
FAR, CONSTANT = 1e-6, 1e-13


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The arrays of a batch as rows of a matrix, unknown entries as NaN. A null array is a row of unknown
    entries; a shorter one lacks its last entries, and of a longer one the first ``width`` are taken."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    if len(sizes) and (sizes == width).all():
        return values[offsets[0]:offsets[-1]].reshape(len(sizes), width)
    out = np.full((len(sizes), width), np.nan)
    for i, (at, n) in enumerate(zip(offsets.tolist(), np.minimum(sizes, width).tolist())):
        out[i, :n] = values[at:at + n]
    return out


def pair_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The six sums of every column of x with every column of y, over the rows where both are known."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    x0, y0, mx, my = np.where(mx, x, 0.0), np.where(my, y, 0.0), mx.astype(float), my.astype(float)
    return np.stack([mx.T @ my, x0.T @ my, mx.T @ y0, (x0 * x0).T @ my, mx.T @ (y0 * y0), x0.T @ y0])


def _task_sums(batches: Iterator[pa.RecordBatch], pairs: list[tuple[int, int]], shifts: tuple[np.ndarray, np.ndarray], block: int) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        x = matrix(batch.column(0), len(shifts[0])) - shifts[0]
        y = matrix(batch.column(1), len(shifts[1])) - shifts[1] if batch.num_columns > 1 else x
        for a, b in pairs:
            part = pair_sums(x[:, a * block:(a + 1) * block], y[:, b * block:(b + 1) * block])
            if (a, b) in held:
                held[a, b] += part
            else:
                held[a, b] = part
    for (a, b), sums in held.items():
        yield pa.RecordBatch.from_pydict({"a": pa.array([a], pa.int32()), "b": pa.array([b], pa.int32()), "sums": [sums.reshape(-1)]})


def early_values(df: DataFrame, vector: str, width: int) -> np.ndarray:
    """For each entry its first known value in the first rows, or zero."""
    rows = np.full((EARLY, width), np.nan)
    for i, r in enumerate(df.select(F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL").head(EARLY)):
        own = r["v"][:width]
        rows[i, :len(own)] = [np.nan if x is None else x for x in own]
    known = ~np.isnan(rows) & ~np.isinf(rows)
    return np.where(known.any(axis=0), rows[known.argmax(axis=0), np.arange(width)], 0.0)


def block_sums(df: DataFrame, left: str, right: str | None, shifts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(a, b, sums): the six sums of each block of pairs. Without ``right`` the pairs are those of ``left`` with
    itself, each block once (a <= b). At most one row per block and task is shuffled."""
    n, m = (-(-len(s) // BLOCK) for s in shifts)
    pairs = [(a, b) for a in range(n) for b in range(m if right else n) if right or a <= b]
    rows = df.select(left, *([right] if right else []))
    parts = [rows.mapInArrow(partial(_task_sums, pairs=pairs[i:i + BLOCKS], shifts=shifts, block=BLOCK), SUMS) for i in range(0, len(pairs), BLOCKS)]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    added = both.groupBy("a", "b").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return added.select("a", "b", vector_to_array("sums").alias("sums"))


def _shape(a: int, b: int, widths: tuple[int, int], block: int) -> tuple[int, int]:
    return min(block, widths[0] - a * block), min(block, widths[1] - b * block)


def _spread(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    n, sx, sy, sxx, syy, sxy = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        return sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n


def _means(batches: Iterator[pa.RecordBatch], widths: tuple[int, int], block: int) -> Iterator[pa.RecordBatch]:
    """(side, at, mean, far) of each column of a block, over the rows known together with the first column of
    the other side that has any."""
    for batch in batches:
        for a, b, flat in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sums"))):
            sums = np.array(flat).reshape(6, *_shape(a, b, widths, block))
            vx, vy, _ = _spread(sums)
            rows = []
            for side, v, s, q, at, axis in ((0, vx, sums[1], sums[3], a, 1), (1, vy, sums[2], sums[4], b, 0)):
                first = sums[0].argmax(axis=axis)
                pick = (np.arange(len(first)), first) if axis else (first, np.arange(len(first)))
                n, s, q, v = sums[0][pick], s[pick], q[pick], v[pick]
                mean = np.divide(s, n, out=np.zeros_like(s), where=n > 0)
                rows += [(side, at * block + i, float(mean[i]), bool(v[i] < FAR * q[i])) for i in range(len(n))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64(), pa.bool_()))],
                                             ["side", "at", "mean", "far"])


def _correlations(batches: Iterator[pa.RecordBatch], widths: tuple[int, int], block: int, mirrored: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, flat in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sums"))):
            sums = np.array(flat).reshape(6, *_shape(a, b, widths, block))
            vx, vy, cov = _spread(sums)
            good = (sums[0] > 1) & (vx > CONSTANT * sums[3]) & (vy > CONSTANT * sums[4])
            r = np.divide(cov, np.sqrt(np.where(good, vx, 1.0)) * np.sqrt(np.where(good, vy, 1.0)), out=np.zeros_like(cov), where=good)
            i, j = np.indices(r.shape)
            columns = [(i + a * block).reshape(-1), (j + b * block).reshape(-1), r.reshape(-1), ~good.reshape(-1)]
            if mirrored and a != b:
                columns = [np.concatenate(x) for x in zip(columns, [columns[1], columns[0], columns[2], columns[3]])]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], mask=columns[3])],
                                             ["i", "j", "r"])


def correlations(df: DataFrame, left: str, width: int, right: str | None = None, right_width: int | None = None) -> DataFrame:
    """(i, j, r): Pearson r of entry i of ``left`` with entry j of ``right``, or with entry j of ``left`` itself.

    Null where fewer than two rows know both, or where one of them is constant there. The driver sees a few early
    rows and, where these lay far from the means, one mean per column; never a block.
    """
    widths = (width, right_width if right else width)
    shifts = [early_values(df, left, width)]
    shifts.append(early_values(df, right, widths[1]) if right else shifts[0])
    blocks = pinned(block_sums(df, left, right, tuple(shifts)))
    means = blocks.mapInArrow(partial(_means, widths=widths, block=BLOCK), "side int, at int, mean double, far boolean")
    if means.where("far").head(1):
        moved = [s.copy() for s in shifts]
        for r in means.groupBy("side", "at").agg(F.max("mean").alias("mean")).collect():
            moved[r["side"]][r["at"]] += r["mean"]
        blocks = pinned(block_sums(df, left, right, (moved[0], moved[1] if right else moved[0])))
    return blocks.mapInArrow(partial(_correlations, widths=widths, block=BLOCK, mirrored=right is None), "i int, j int, r double")


def entry_names(names: list[str], at: str) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), F.col(at))
