"""Quality rules: fixed rules on repetition and length, then gradient-boosted trees over document statistics.

Statistics come from whole Arrow batches at once (byte classes, sums per row, sorted window hashes).
The trees are fitted in numpy on a bounded sample of labelled documents, with histogram splits and
monotonic constraints, and flattened into node arrays that score a batch level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from commentscope.llm.common import SPACES, bounded_sample, covered, mixed, quoted, slices, text_bytes, text_or_empty, whole_windows, window_hashes, word_hashes, words_of

#: Labelled documents used for fitting, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 4_000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Features of the trees, with the direction in which the score (of being good) may move: -1 down, 0 free.
FEATURES = {
    "log_words": 0, "mean_word_chars": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_word_share": -1, "upper_share": -1,
    "bang_share": -1, "digit_share": -1, "punctuation_share": 0, "words_per_line": 0, "distinct_word_share": 0, "long_word_share": -1,
}

_SPACE, _SYMBOL, _UPPER, _BANG, _DIGIT, _PUNCT, _CONT, _LF = (np.uint8(1 << i) for i in range(8))


def _classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for chars, flag in ((SPACES, _SPACE), (SYMBOLS, _SYMBOL), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), (b"!?", _BANG), (b"0123456789", _DIGIT),
                        (b".,;:'\"()-", _PUNCT), (bytes(range(0x80, 0xC0)), _CONT), (b"\n", _LF)):
        table[list(chars)] |= flag
    return table


CLASSES = _classes()


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many true values each row has."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counted statistics and the feature matrix of a string column without nulls."""
    data, bounds = text_bytes(column)
    kind = CLASSES[data]
    has = lambda flag: (kind & flag) != 0
    chars = _per_row(~has(_CONT), bounds)
    word_chars = _per_row((kind & (_SPACE | _CONT)) == 0, bounds)
    whole = data.tobytes()
    texts = [whole[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    words, word_bounds = words_of(texts)
    n_words = np.diff(word_bounds)
    hashes, doc = word_hashes(words), np.repeat(np.arange(len(texts)), n_words)
    own = mixed(hashes) + mixed(doc.astype(np.uint64) + np.uint64(1))
    distinct = np.zeros(len(own), bool)
    distinct[np.unique(own, return_index=True)[1]] = True
    repeat = np.zeros(len(own), bool)
    inside = whole_windows(word_bounds, WINDOW, len(own))
    if inside.any():
        starts = np.flatnonzero(inside)
        keys = mixed(window_hashes(hashes, WINDOW)[WINDOW][starts]) + mixed(doc[starts].astype(np.uint64) + np.uint64(1))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        repeat = covered(starts[twice], WINDOW, len(own))
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    n_lines = np.array([len(x) for x in lines], np.int64)
    n_dup = n_lines - np.array([len(set(x)) for x in lines], np.int64)
    long_words = _per_row(np.fromiter(map(len, words), np.int64, len(words)) > 25, word_bounds)
    counts = {"n_words": n_words, "word_chars": word_chars, "n_symbols": _per_row(has(_SYMBOL), bounds), "n_dup_lines": n_dup,
              "n_repeat_words": _per_row(repeat, word_bounds)}
    share = lambda a, b: a / np.maximum(b, 1)
    x = np.stack([
        np.log1p(n_words), share(word_chars, n_words), share(counts["n_symbols"], chars), share(n_dup, n_lines),
        share(counts["n_repeat_words"], n_words), share(_per_row(has(_UPPER), bounds), word_chars), share(_per_row(has(_BANG), bounds), chars),
        share(_per_row(has(_DIGIT), bounds), chars), share(_per_row(has(_PUNCT), bounds), chars), share(n_words, n_lines),
        share(_per_row(distinct, word_bounds), n_words), share(long_words, n_words)], axis=1)
    return counts, x


# ---- boosted trees -------------------------------------------------------------------------

@dataclass
class Trees:
    """Nodes of all trees in flat arrays; a leaf is its own child. Rows go right when above the cut."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of being good, for all rows and trees at once."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] > self.cut[at], self.right[at], self.left[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15,
              bins: int = 64, ridge: float = 1.0, least: float = 4.0) -> Trees:
    """Logistic boosting with histogram splits. A split on a constrained feature must order its two
    leaf values by the sign, and the middle between them bounds all leaves below it."""
    share = np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots: list[int] = []

    def leaf(value: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), value])
        return len(nodes) - 1

    if len(y) == 0 or y.min() == y.max():
        roots.append(leaf(0.0))
    else:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        raw = np.full(len(y), start)

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            g, h = grad[rows].sum(), hess[rows].sum()
            own = float(np.clip(-g / (h + ridge), low, high))
            best = (1e-6, None)
            for j, c in enumerate(cuts):
                if level == depth or not len(c):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], len(c) + 1))[:-1]
                gr, hr = g - gl, h - hl
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                gain = -(gl * vl + 0.5 * (hl + ridge) * vl**2) - (gr * vr + 0.5 * (hr + ridge) * vr**2) + (g * own + 0.5 * (h + ridge) * own**2)
                allowed = (hl >= least * 0.05) & (hr >= least * 0.05) & (signs[j] * (vr - vl) >= 0)
                gain = np.where(allowed, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, vl[k], vr[k]))
            if best[1] is None:
                raw[rows] += rate * own
                return leaf(rate * own)
            j, k, vl, vr = best[1]
            at = leaf(0.0)
            go = binned[rows, j] > k
            mid = (vl + vr) / 2
            bound_l, bound_r = ((low, high), (low, high)) if signs[j] == 0 else (((low, mid), (mid, high)) if signs[j] > 0 else ((mid, high), (low, mid)))
            left, right = grow(rows[~go], level + 1, *bound_l), grow(rows[go], level + 1, *bound_r)
            nodes[at] = [j, cuts[j][k], left, right, 0.0]
            return at

        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0, -4.0, 4.0))
    f, c, a, b, v = (np.array(z) for z in zip(*nodes))
    return Trees(f.astype(np.int64), c.astype(float), a.astype(np.int64), b.astype(np.int64), v.astype(float), np.array(roots), depth, start)


# ---- Spark ---------------------------------------------------------------------------------

SCORED = "text string, " + ", ".join(f"{s} long" for s in STATS) + ", score double"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (s for batch in batches for s in slices(batch, 0)):
        _, x = statistics(part.column("text"))
        yield pa.RecordBatch.from_pydict({"x": pa.array(list(x), pa.list_(pa.float64())), "good": part.column("good")})


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees from at most ``rows`` labelled documents; without two classes every document scores alike. Of an id
    that stands on several rows the smallest text is taken, on the executors: the bound is one of rows too."""
    known = (labels.where(F.col(quoted(id_col)).isNotNull() & F.col("quality").isNotNull())
             .groupBy(F.col(quoted(id_col)).alias("l_id")).agg(F.min("quality").cast("double").alias("good")))
    # the sample's bound is the parameter: a broadcast of that many ids
    sample = bounded_sample(known, rows, F.xxhash64("l_id"))
    texts = (docs.select(F.col(quoted(id_col)).alias("__id"), text_or_empty(text_col).alias("text")).join(F.broadcast(sample), F.col("__id") == F.col("l_id"))
             .groupBy("l_id").agg(F.min("text").alias("text"), F.min("good").alias("good")).select("text", "good"))
    got = texts.mapInArrow(_features, "x array<double>, good double").toPandas()
    got = got.assign(k=[tuple(v) for v in got["x"]]).sort_values(["k", "good"])  # rows arrive in any order
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    return fit_trees(x, got["good"].to_numpy(float), np.array(list(FEATURES.values())))


def _scored(batches: Iterator[pa.RecordBatch], trees: Trees, names: list[str]) -> Iterator[pa.RecordBatch]:
    for part in (s for batch in batches for s in slices(batch, batch.num_columns - 1)):
        counts, x = statistics(part.column(part.num_columns - 1))
        score = trees.score(x)
        yield pa.RecordBatch.from_arrays(
            [*part.columns[:-1], *(pa.array(counts[s], pa.int64()) for s in STATS), pa.array(score, pa.float64())], names)


#: A document is rejected when the trees give it less than this chance of being good.
REJECT_BELOW = 0.1


def judge(docs: DataFrame, trees: Trees, carry: list[str], text_col: str = "text", reject_below: float = REJECT_BELOW,
          prefix: str = "") -> DataFrame:
    """The carried columns, the statistics, ``score``, ``base_failed`` and ``kept`` for every row.

    Words are runs of other than the six ASCII blanks. A null text has no words and fails the base
    rule, as every text under ten words does. Repeated rows are judged alike. Names of the added
    columns start with ``prefix``, so that carried columns of the same name stay whole.
    """
    rows = docs.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carry)], text_or_empty(text_col).alias("judged_text"))
    added = [*STATS, "score"]
    schema = StructType([*rows.schema.fields[:-1], *[StructField("a_" + s, DoubleType() if s == "score" else LongType()) for s in added]])
    out = rows.mapInArrow(partial(_scored, trees=trees, names=schema.names), schema).toDF(*carry, *[prefix + s for s in added])
    n, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    failed = (n < 10) | (100 * repeated > 20 * n)
    return out.withColumn(prefix + "base_failed", failed).withColumn(
        prefix + "kept", ~F.col(prefix + "base_failed") & (F.col(prefix + "score") >= reject_below))
