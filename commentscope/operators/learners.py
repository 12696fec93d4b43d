"""Base learners: Spark ML estimators under the settings of the study, and AdaBoost."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.sql import functions as F

from commentscope.operators.boosting import AdaBoost, AdaBoostModel

__all__ = ["AdaBoost", "AdaBoostModel", "class_moments", "gaussian_naive_bayes", "gradient_boosting", "logistic_regression", "random_forest"]

MOST_DEPTH = 30


def logistic_regression(rows: int, weight_col: str | None = None, max_iter: int = 100) -> LogisticRegression:
    """L2 penalty of strength one over the number of rows, on unscaled features."""
    est = LogisticRegression(maxIter=max_iter, regParam=1.0 / max(rows, 1), standardization=False)
    return est.setWeightCol(weight_col) if weight_col else est


def random_forest(trees: int = 100, depth: int = 10, weight_col: str | None = None) -> RandomForestClassifier:
    """Deeper trees than the engine grows are refused, never replaced by others."""
    if depth > MOST_DEPTH:
        raise ValueError(f"the engine grows trees of depth {MOST_DEPTH} at most, {depth} was asked for")
    est = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=0)
    return est.setWeightCol(weight_col) if weight_col else est


def gaussian_naive_bayes() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian")


def gradient_boosting(rounds: int = 20, depth: int = 5, rate: float = 0.1, subsample: float = 1.0,
                      min_rows: int = 1, weight_col: str | None = None, min_gain: float = 0.0,
                      column_share: float = 1.0) -> GBTClassifier:
    """``min_gain`` is the least gain of a split, ``column_share`` the share of features tried per split."""
    est = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
                        minInstancesPerNode=min_rows, minInfoGain=min_gain,
                        featureSubsetStrategy="all" if column_share >= 1 else str(column_share), seed=0)
    return est.setWeightCol(weight_col) if weight_col else est


def class_moments(long, label_cols: list[str]):
    """(feature, label, y, n, prior, mean, variance) of every class, from a long feature table."""
    pairs = F.array(*[F.struct(F.lit(l).alias("label"), F.col(l).cast("int").alias("y")) for l in label_cols])
    rows = long.select("feature", "value", F.explode(pairs).alias("p")).select("feature", "value", "p.*")
    cls = rows.groupBy("feature", "label", "y").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance"))
    total = cls.groupBy("feature", "label").agg(F.sum("n").alias("__n"))
    return cls.join(total, ["feature", "label"]).select(
        "feature", "label", "y", "n", (F.col("n") / F.col("__n")).alias("prior"), "mean", "variance")
