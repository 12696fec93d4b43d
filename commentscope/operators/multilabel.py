"""Problem transforms for multi-label classification, grid search and cross-validation.

Every ``fit_*`` returns a ``FittedTransform``: called on a DataFrame it adds ``p_<label>``, the
probability of each label; it can be saved and loaded.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentscope.operators import metrics as M
from commentscope.operators.boosting import AdaBoostModel
from commentscope.operators.reports import METRICS, union_tables
from commentscope.plans.ordering import pinned

Predictor = Callable[[DataFrame], DataFrame]
SCRATCH = ["__prediction", "__probability", "__raw", "__label"]


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Named features to one vector; order is the order of the names."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def vector_from_array(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.transform(column, lambda x: x.cast("double"))))


def configured(est: Estimator, features: str) -> Estimator:
    """Copy of an estimator with scratch output columns and an integer label column."""
    e = est.copy()
    for name, value in (("featuresCol", features), ("labelCol", "__label"),
                        ("predictionCol", "__prediction"), ("probabilityCol", "__probability"),
                        ("rawPredictionCol", "__raw")):
        if e.hasParam(name):
            e.set(e.getParam(name), value)
    return e


def fit_one(est: Estimator, df: DataFrame, label: str, features: str = "features"):
    return configured(est, features).fit(df.withColumn("__label", F.col(label).cast("double")))


def add_probability(model, df: DataFrame, label: str) -> DataFrame:
    out = model.transform(df)
    return out.withColumn(f"p_{label}", vector_to_array("__probability")[1]).drop(*SCRATCH)


@dataclass
class FittedTransform:
    """A problem transform with its fitted models: called on rows, it adds ``p_<label>``. It can be saved."""

    kind: str
    labels: list[str]
    features: str
    models: list
    combos: list[str] = field(default_factory=list)
    binary_only: bool = False

    def __call__(self, rows: DataFrame) -> DataFrame:
        return getattr(self, f"_{self.kind}")(rows)

    def _binary_relevance(self, rows: DataFrame) -> DataFrame:
        for l, model in zip(self.labels, self.models):
            rows = add_probability(model, rows, l)
        return rows

    def _classifier_chain(self, rows: DataFrame) -> DataFrame:
        for j, (l, model) in enumerate(zip(self.labels, self.models)):
            rows = add_probability(model, with_previous(rows, self.features, [f"__y{i}" for i in range(j)]), l)
            rows = rows.drop("__chain").withColumn(f"__y{j}", (F.col(f"p_{l}") >= 0.5).cast("double"))
        return rows.drop(*[f"__y{j}" for j in range(len(self.labels))])

    def _label_powerset(self, rows: DataFrame) -> DataFrame:
        if not self.models:
            return rows.withColumns({f"p_{l}": F.lit(float(self.combos[0][i])) for i, l in enumerate(self.labels)})
        out = self.models[0].transform(rows)
        if self.binary_only:
            out = out.withColumn("__shares", F.transform(vector_to_array("__raw"), lambda x: 1.0 / (1.0 + F.exp(-x))))
        else:
            out = out.withColumn("__shares", vector_to_array("__probability"))
        out = out.withColumn("__total", F.aggregate("__shares", F.lit(0.0), lambda a, x: a + x))
        for i, l in enumerate(self.labels):
            p = F.lit(0.0)
            for c, combo in enumerate(self.combos):
                if combo[i] == "1":
                    p = p + F.get("__shares", F.lit(c))
            out = out.withColumn(f"p_{l}", p / F.col("__total"))
        return out.drop(*SCRATCH, "__shares", "__total")

    def save(self, path: str) -> None:
        """One folder per model, and the description as one line of JSON, in a file system that Spark reaches."""
        for i, model in enumerate(self.models):
            save_model([model], f"{path}/model-{i}")
        spec = {"kind": self.kind, "labels": self.labels, "features": self.features, "combos": self.combos,
                "binary_only": self.binary_only, "models": len(self.models)}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")

    @staticmethod
    def load(path: str) -> FittedTransform:
        spec = json.loads(SparkSession.active().read.text(f"{path}/spec").head()[0])
        return FittedTransform(models=[load_model(f"{path}/model-{i}") for i in range(spec.pop("models"))], **spec)


def with_previous(rows: DataFrame, features: str, previous: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=[features, *previous], outputCol="__chain").transform(rows)


def fit_binary_relevance(df: DataFrame, labels: list[str], est: Estimator | dict[str, Estimator],
                         features: str = "features", parallelism: int = 3) -> FittedTransform:
    """One independent model per label, or one with its own settings each; fits overlap."""
    pick = lambda l: est[l] if isinstance(est, dict) else est
    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(lambda l: fit_one(pick(l), df, l, features), labels))
    return FittedTransform("binary_relevance", list(labels), features, models)


def fit_classifier_chain(df: DataFrame, labels: list[str], est: Estimator,
                         features: str = "features") -> FittedTransform:
    """Label j also sees the labels before it: the true ones in training, the predicted ones after."""
    models = [fit_one(est, with_previous(df, features, labels[:j]), l, "__chain") for j, l in enumerate(labels)]
    return FittedTransform("classifier_chain", list(labels), features, models)


def fit_label_powerset(df: DataFrame, labels: list[str], est: Estimator, features: str = "features",
                       binary_only: bool = False) -> FittedTransform:
    """Each combination of labels seen in training is one class; a label's probability is the
    sum over the classes that hold it. A two-class learner is wrapped one-versus-rest."""
    tagged = df.withColumn("__combo", F.concat_ws("", *[F.col(l).cast("string") for l in labels]))
    indexer = StringIndexer(inputCol="__combo", outputCol="__class", stringOrderType="alphabetAsc").fit(tagged)
    combos = list(indexer.labels)
    indexed = indexer.transform(tagged)
    if len(combos) < 2:
        models = []
    elif binary_only:
        models = [OneVsRest(classifier=configured(est, features), featuresCol=features, labelCol="__class",
                            predictionCol="__prediction", rawPredictionCol="__raw").fit(indexed)]
    else:
        models = [fit_one(est, indexed, "__class", features)]
    return FittedTransform("label_powerset", list(labels), features, models, combos, binary_only)


TRANSFORMS = {"binary_relevance": fit_binary_relevance, "classifier_chain": fit_classifier_chain,
              "label_powerset": fit_label_powerset}


def grid_search(df: DataFrame, label: str, est: Estimator, grid: list[dict], fold_col: str,
                metric: str = "f1", folds: int = 5, features: str = "features",
                parallelism: int = 4):
    """(best model, table of grid points with mean and deviation over the folds).

    ``metric`` is f1 (of the positive class), weightedFMeasure or accuracy. Folds come from
    an integer column, so every point sees the same rows.
    """
    base = configured(est, features)
    points = [{base.getParam(k): v for k, v in point.items()} for point in grid]
    evaluator = MulticlassClassificationEvaluator(labelCol="__label", predictionCol="__prediction")
    evaluator = (evaluator.setMetricName("fMeasureByLabel").setMetricLabel(1.0) if metric == "f1"
                 else evaluator.setMetricName(metric))
    cv = CrossValidator(estimator=base, estimatorParamMaps=points, evaluator=evaluator, numFolds=folds,
                        foldCol=fold_col, parallelism=parallelism, collectSubModels=False)
    fitted = cv.fit(df.withColumn("__label", F.col(label).cast("double")))
    rows = [(", ".join(f"{k}={v}" for k, v in sorted(p.items())), float(m), float(s))
            for p, m, s in zip(grid, fitted.avgMetrics, fitted.stdMetrics)]
    table = df.sparkSession.createDataFrame(rows, "point string, mean double, std double")
    return fitted.bestModel, table


def kfold_evaluate(df: DataFrame, key: str, labels: list[str], fit: Callable[[DataFrame], Predictor],
                   fold_col: str = "fold", folds: int = 5) -> DataFrame:
    """(fold, six scores): every fold scored by a model of the others."""
    parts = []
    for k in range(folds):
        predict = fit(df.where(F.col(fold_col) != k))
        scored = M.score_rows(predict(df.where(F.col(fold_col) == k)), [key], labels)
        parts.append(scored.withColumn("fold", F.lit(k)))
    return M.evaluate(union_tables(parts), key, ["fold"]).select("fold", *METRICS)


def kfold_score(df: DataFrame, key: str, labels: list[str], fit: Callable[[DataFrame], Predictor], score: str,
                fold_col: str = "fold", folds: int = 5) -> DataFrame:
    """(score, mean, std): one named score of all labels together over the folds of an integer column."""
    scores = kfold_evaluate(df, key, labels, fit, fold_col, folds)
    return scores.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std")).select(F.lit(score).alias("score"), "mean", "std")


def grid_search_transform(df: DataFrame, key: str, labels: list[str], transform: Callable, est: Estimator, grid: list[dict],
                          score: str = "f1_weighted", fold_col: str = "fold", folds: int = 5, parallelism: int = 4):
    """(best fitted transform, table of grid points): a problem transform is fitted with every point of the grid,
    and its score over all labels is averaged over the folds. Ties go to the earlier point.

    A point names settings of the learner; its entry ``transform`` chooses another transform by name. The folds are
    written once and shared. Fits of points and folds overlap, at most ``parallelism`` at a time; a point that
    stands in the grid again is fitted once. One evaluation scores all points and folds together.
    """
    named = [", ".join(f"{k}={v}" for k, v in sorted(p.items())) for p in grid]
    points = dict(zip(named, grid))
    shared = pinned(df)

    def fitted(rows: DataFrame, point: dict) -> Predictor:
        chosen = TRANSFORMS[point["transform"]] if "transform" in point else transform
        return chosen(rows, labels, est.copy({est.getParam(k): v for k, v in point.items() if k != "transform"}))

    def scored(task: tuple[str, int]) -> DataFrame:
        name, k = task
        predict = fitted(shared.where(F.col(fold_col) != k), points[name])
        rows = M.score_rows(predict(shared.where(F.col(fold_col) == k)), [key], labels)
        return rows.select("*", F.lit(name).alias("point"), F.lit(k).alias("fold"))

    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(scored, [(name, k) for name in points for k in range(folds)]))
    per_fold = M.evaluate(union_tables(parts), key, ["point", "fold"])
    table = pinned(per_fold.groupBy("point").agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std")))
    means = {r["point"]: r["mean"] for r in table.collect()}  # one row per grid point
    sign = -1 if score == "log_loss" else 1
    best = max(range(len(grid)), key=lambda i: (sign * means[named[i]], -i))
    return fitted(shared, grid[best]), table


def save_model(stages: list, path: str) -> None:
    """Engine models as one pipeline; a boosted model as its stumps and settings."""
    if len(stages) == 1 and isinstance(stages[0], AdaBoostModel):
        stages[0].save(path)
    else:
        PipelineModel(stages).write().overwrite().save(path)


def load_model(path: str):
    """The kind is told by the folder's own metadata."""
    meta = json.loads(SparkSession.active().read.text(f"{path}/metadata").head()[0])
    return AdaBoostModel.load(path) if meta["class"] == AdaBoostModel.SAVED_AS else PipelineModel.load(path)
