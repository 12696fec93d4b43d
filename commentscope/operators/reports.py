"""Tables of model scores: (model, metrics...), one row per model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentscope.operators.metrics import evaluate

METRICS = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "log_loss",
           "roc_auc_weighted"]
SMALLER_IS_BETTER = {"log_loss"}


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Stacked by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def mean_fold_scores(folds: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    return folds.groupBy("model").agg(*[F.avg(m).alias(m) for m in metrics or METRICS])


def best_and_second(scores: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """(metric, place, model, value): the best value and the next distinct one, ties kept."""
    metrics = metrics or METRICS
    long = scores.unpivot(["model"], [F.col(m) for m in metrics], "metric", "value")
    better = F.when(F.col("metric").isin(list(SMALLER_IS_BETTER)), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy("metric").orderBy(F.desc_nulls_last(better))
    ranked = long.where("value is not null").withColumn("place", F.dense_rank().over(w))
    return ranked.where("place <= 2").select("metric", "place", "model", "value")


def common_top(scores: DataFrame, k: int, high: str = "f1_weighted", low: str = "log_loss") -> DataFrame:
    """Models among the k highest by one metric and the k lowest by another, best first."""
    a = scores.orderBy(F.desc(high), "model").limit(k).select("model")
    b = scores.orderBy(low, "model").limit(k).select("model")
    return scores.join(a.intersect(b), "model").orderBy(F.desc(high), "model")


def side_by_side(a: DataFrame, b: DataFrame, mapping: DataFrame, suffixes=("_a", "_b")) -> DataFrame:
    """Two score tables on one row per pair of model names (columns model_a, model_b)."""
    tag = lambda df, s: df.select(*[F.col(c).alias(f"{c}{s}") for c in df.columns])
    left, right = (f"model{s}" for s in suffixes)
    names = mapping.toDF(left, right)
    return names.join(tag(a, suffixes[0]), left).join(tag(b, suffixes[1]), right)


def compare_scorers(scored: DataFrame, key: str, by: str = "model") -> DataFrame:
    """The scores of several scorers side by side, over all rows and over the rows that no
    scorer failed on (column ``rows``: all, scored). A failed row has only zero scores."""
    failed = (scored.groupBy(by, key).agg(F.max("prob").alias("__m")).where("__m = 0")
                    .select(key).distinct().withColumn("__failed", F.lit(True)))
    marked = scored.join(failed, key, "left")
    kinds = F.when(F.col("__failed"), F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), F.lit("scored")))
    both = marked.withColumn("rows", F.explode(kinds)).drop("__failed")
    return evaluate(both, key, [by, "rows"])


def weighted_ensemble(scores: DataFrame, key: str, weights: dict[str, float], cut: float = 0.5) -> DataFrame:
    """(key, label, y, prob, pred): weighted sum of the models' probabilities.

    ``scores`` is the long table with a ``model`` column; every model scores every row.
    """
    models = list(weights)
    picks = [F.max(F.when(F.col("model") == m, F.col("prob"))).alias(f"__p{i}")
             for i, m in enumerate(models)]
    rows = (scores.where(F.col("model").isin(models)).groupBy(key, "label")
                  .agg(F.max("y").alias("y"), *picks))
    # a fixed order of addition, so a sum on the cut falls on the same side every time
    prob = reduce(lambda a, b: a + b,
                  [F.col(f"__p{i}") * F.lit(float(w)) for i, w in enumerate(weights.values())])
    return (rows.select(key, "label", "y", prob.alias("prob"))
                .withColumn("pred", (F.col("prob") >= cut).cast("int")))
