"""Two-class AdaBoost (SAMME.R) over decision stumps, one aggregate per round.

Features are cut into at most ``BINS`` bins once and written once, as bytes. A stump adds one of two numbers to a
row's margin, by the bin of one feature, so all stumps so far are one table of numbers per used feature, and a row's
weight, exp(-rate * y * margin) over the sum of all, comes from its bytes and these tables. A round therefore
writes nothing: each task weighs its rows and sums them per feature, bin and class; the sums of all tasks are
added by the engine's vector aggregate, and the driver, which sees one number per feature, bin and class, takes
the best cut.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentscope.plans.moments import matrix
from commentscope.plans.ordering import pinned

BINS = 64
#: Rows of a written block.
BLOCK = 1 << 16
#: Shares are kept this far from 0 and 1, as in the published algorithm's library form.
EPSILON = sys.float_info.epsilon
#: Quantiles are off by at most this part of the rows.
ACCURACY = 10_000


def half_log_odds(share: float) -> float:
    p = min(max(share, EPSILON), 1.0 - EPSILON)
    return 0.5 * (math.log(p) - math.log(1.0 - p))


def cuts(df: DataFrame, features: str, width: int) -> list[np.ndarray]:
    """For each feature the middles between neighbouring quantiles: at most ``BINS - 1`` cuts."""
    grid = [i / BINS for i in range(BINS + 1)]
    found = []
    for at in range(0, width, 256):  # columns of one aggregate
        own = range(at, min(at + 256, width))
        row = df.agg(*[F.percentile_approx(F.get(features, F.lit(i)), grid, ACCURACY).alias(f"q{i}") for i in own]).head()
        found += [np.unique(np.array(row[f"q{i}"] or [], float)) for i in own]
    middles = [(q[:-1] + q[1:]) / 2 for q in found]
    return [m if len(m) < BINS else m[np.linspace(0, len(m) - 1, BINS - 1).astype(int)] for m in middles]


def _binned(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows as bytes: the bins, feature by feature, and the classes."""
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            x, y = matrix(part.column(0), len(edges)), part.column(1).to_numpy(zero_copy_only=False)
            bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"x": pa.array([bins.tobytes()], pa.binary()), "y": pa.array([(y == 1).astype(np.uint8).tobytes()], pa.binary())})


def _class_sums(batches: Iterator[pa.RecordBatch], width: int, tables: dict[int, np.ndarray], constant: float, log_total: float) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((width, 2 * BINS))
    for batch in batches:
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            y = np.frombuffer(y, np.uint8).astype(np.int64)
            bins = np.frombuffer(x, np.uint8).reshape(width, len(y))
            margin = np.full(len(y), constant)
            for f, table in tables.items():
                margin += table[bins[f]]
            weight = np.exp(np.where(y == 1, -margin, margin) - log_total)
            for f in range(width):
                sums[f] += np.bincount(2 * bins[f].astype(np.int64) + y, weights=weight, minlength=2 * BINS)
    yield pa.RecordBatch.from_pydict({"sums": [sums.reshape(-1)]})


def best_cut(sums: np.ndarray) -> tuple[int, int, float, float]:
    """(feature, last bin to the left, share of class 1 on the left, on the right) with the lowest weighted Gini
    impurity; feature -1 where no cut lowers it. ``sums`` is (features, bins, classes); ties go to the first."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    right = sums.sum(axis=1, keepdims=True) - left

    def impurity(s: np.ndarray) -> np.ndarray:
        total = s.sum(axis=-1)
        return np.divide(2 * s[..., 0] * s[..., 1], total, out=np.zeros_like(total), where=total > 0)

    share = lambda s: float(s[1] / s.sum()) if s.sum() > 0 else 0.5
    both = np.where((left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0), impurity(left) + impurity(right), np.inf)
    f, b = np.unravel_index(both.argmin(), both.shape)
    whole = sums[0].sum(axis=0)
    if not both[f, b] < impurity(whole[None])[0] * (1 - 1e-12):
        return -1, 0, share(whole), share(whole)
    return int(f), int(b), share(left[f, b]), share(np.maximum(right[f, b], 0.0))


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    rounds = Param(Params._dummy(), "rounds", "number of stumps", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "shrinks the weight update", TypeConverters.toFloat)


class AdaBoost(Estimator, _BoostParams):
    """A round fits one weighted stump on the whole table and multiplies each row's weight by exp(-rate * y * h),
    where h is half the log-odds of the stump's class shares and y is +1 or -1; weights sum to one."""

    @keyword_only
    def __init__(self, *, rounds: int = 50, rate: float = 1.0, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self._setDefault(rounds=50, rate=1.0)
        self._set(**self._input_kwargs)

    def setLabelCol(self, value):
        return self._set(labelCol=value)

    def _fit(self, df: DataFrame) -> "AdaBoostModel":
        rows = df.select(vector_to_array(self.getFeaturesCol()).alias("features"), F.col(self.getLabelCol()).cast("double").alias("label"))
        first = rows.where("features IS NOT NULL").head()
        if first is None:
            raise ValueError("no rows to learn from")
        width, rate = len(first["features"]), self.getOrDefault(self.rate)
        edges = cuts(rows, "features", width)
        blocks = pinned(rows.mapInArrow(partial(_binned, edges=edges), "x binary, y binary"))
        stumps, tables, constant, log_total = [], {}, 0.0, math.log(rows.count())
        for _ in range(self.getOrDefault(self.rounds)):
            parts = blocks.mapInArrow(partial(_class_sums, width=width, tables=tables, constant=constant, log_total=log_total), "sums array<double>")
            added = parts.agg(Summarizer.sum(array_to_vector("sums")).alias("s")).head()["s"]
            sums = added.toArray().reshape(width, BINS, 2)
            f, b, low, high = best_cut(sums)
            left, right = half_log_odds(low), half_log_odds(high)
            stumps.append((f, float(edges[f][b]) if f >= 0 else 0.0, left, right))
            below = sums[f, :b + 1].sum(axis=0) if f >= 0 else sums[0].sum(axis=0)
            above = sums[f, b + 1:].sum(axis=0) if f >= 0 else np.zeros(2)
            if f >= 0:
                table = tables.get(f, np.zeros(BINS))
                tables = tables | {f: table + rate * np.where(np.arange(BINS) <= b, left, right)}
            else:
                constant += rate * left
            # the sum of the new weights, from the sums of the old ones on both sides of the cut
            total = sum(s[c] * math.exp((-1 if c else 1) * rate * h) for s, h in ((below, left), (above, right)) for c in (0, 1))
            log_total += math.log(max(total, sys.float_info.min))
        return self._copyValues(AdaBoostModel(stumps))


class AdaBoostModel(Model, _BoostParams):
    """Sum of the stumps' half log-odds; the class share is its logistic. A stump is (feature, cut, value up to
    the cut, value above it); feature -1 is a constant."""

    SAVED_AS = "commentscope.AdaBoostModel"

    def __init__(self, stumps=None):
        super().__init__()
        self.stumps = [tuple(s) for s in stumps or []]

    def save(self, path: str) -> None:
        """Stumps and column names as one line of JSON."""
        names = {p.name: self.getOrDefault(p) for p in self.params if p.name.endswith("Col") and self.isDefined(p)}
        meta = json.dumps({"class": self.SAVED_AS, "columns": names, "stumps": self.stumps})
        SparkSession.active().createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> "AdaBoostModel":
        meta = json.loads(SparkSession.active().read.text(f"{path}/metadata").head()[0])
        model = cls(meta["stumps"])
        for name, value in meta["columns"].items():
            model.set(model.getParam(name), value)
        return model

    def steps(self) -> tuple[float, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """The sum of all stumps as a constant and, per used feature, ascending cuts with the values between them."""
        constant = sum(left for f, _, left, _ in self.stumps if f < 0)
        out = {}
        for f in sorted({s[0] for s in self.stumps if s[0] >= 0}):
            own = [s[1:] for s in self.stumps if s[0] == f]
            edges = np.unique([c for c, _, _ in own])
            values = np.zeros(len(edges) + 1)
            for c, left, right in own:
                at = int(np.searchsorted(edges, c)) + 1
                values[:at] += left
                values[at:] += right
            out[f] = (edges, values)
        return constant, out

    def _transform(self, df: DataFrame) -> DataFrame:
        constant, steps = self.steps()

        @F.pandas_udf("double")
        def total(rows: pd.Series) -> pd.Series:
            out = np.full(len(rows), float(constant))
            x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, 0))
            for f, (edges, values) in steps.items():
                if len(x):
                    out += values[np.searchsorted(edges, x[:, f], side="left")]
            return pd.Series(out)

        out = df.withColumn("__sum", total(vector_to_array(self.getFeaturesCol())))
        p = 1.0 / (1.0 + F.exp(-2.0 * F.col("__sum") / max(len(self.stumps), 1)))
        return (out.withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-F.col("__sum"), F.col("__sum"))))
                   .withColumn(self.getProbabilityCol(), array_to_vector(F.array(1.0 - p, p)))
                   .withColumn(self.getPredictionCol(), (F.col("__sum") > 0).cast("double")).drop("__sum"))
