"""Metrics over long score tables (id, label, y, pred, prob), optionally grouped further."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.plans.ordering import pinned, running_totals

EPS = 1e-15


def clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(EPS)), F.lit(1.0 - EPS))


def score_rows(df: DataFrame, ids: list[str], labels: list[str], prob: str = "p_{}",
               cut: float = 0.5) -> DataFrame:
    """Wide labels and probabilities to (ids, label, y, pred, prob)."""
    p = lambda l: F.col(prob.format(l)).cast("double")
    items = F.array(*[F.struct(F.lit(l).alias("label"), F.col(l).cast("int").alias("y"),
                               (p(l) >= cut).cast("int").alias("pred"), p(l).alias("prob"))
                      for l in labels])
    return df.select(*ids, F.inline(items))


def row_scores(scored: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy over whole rows and the multi-label log loss, from one grouping by row.

    Log loss is the multiclass formula on multi-label rows: clip, scale each row to sum one,
    then the mean over rows of the negative log over its true labels.
    """
    by = by or []
    p, y = clipped(F.col("prob")), F.col("y")
    rows = scored.groupBy(*by, key).agg(
        F.min((y == F.col("pred")).cast("int")).alias("ok"), F.sum(p).alias("s"),
        F.sum(y * F.log(p)).alias("a"), F.sum(y).alias("m"))
    return rows.groupBy(*by).agg(F.avg("ok").alias("accuracy"),
                                 F.avg(F.col("m") * F.log("s") - F.col("a")).alias("log_loss"))


def subset_accuracy(scored: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """Share of rows with every label right."""
    return row_scores(scored, key, by).drop("log_loss")


def log_loss_multilabel(scored: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    return row_scores(scored, key, by).drop("accuracy")


def score_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(label, prob, pred, pos, neg): rows counted per distinct score.

    Every per-label measure follows from these counts, so the score table is read once.
    """
    return scored.groupBy(*(by or []), "label", "prob", "pred").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))


def confusion(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(label, tn, fp, fn, tp)."""
    return _confusion(score_counts(scored, by), by)


def _confusion(counts: DataFrame, by: list[str] | None) -> DataFrame:
    cell = lambda side, pred: F.sum(F.when(F.col("pred") == pred, F.col(side)).otherwise(0)).cast("long")
    return counts.groupBy(*(by or []), "label").agg(
        cell("neg", 0).alias("tn"), cell("neg", 1).alias("fp"),
        cell("pos", 0).alias("fn"), cell("pos", 1).alias("tp"))


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    """Positive-class scores from confusion counts, 0 where undefined."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return (counts.withColumn("support", F.col("tp") + F.col("fn"))
                  .withColumn("accuracy", F.try_divide(F.col("tp") + F.col("tn"),
                                                       F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))
                  .withColumn("precision", safe(tp, tp + fp))
                  .withColumn("recall", safe(tp, tp + fn))
                  .withColumn("f1", safe(2 * tp, 2 * tp + fp + fn)))


def weighted_scores(per_label: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per-label scores averaged with the true positives in the truth as weights."""
    mean = lambda c: F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")),
                                             F.sum("support").cast("double")), F.lit(0.0))
    return per_label.groupBy(*(by or [])).agg(*[mean(c).alias(f"{c}_weighted")
                                                for c in ("precision", "recall", "f1")])


def log_loss_binary(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(label, log_loss) of each label on its own."""
    return _log_loss_binary(score_counts(scored, by), by)


def _log_loss_binary(counts: DataFrame, by: list[str] | None) -> DataFrame:
    p = clipped(F.col("prob"))
    loss = F.sum(-F.col("pos") * F.log(p) - F.col("neg") * F.log(1.0 - p))
    return counts.groupBy(*(by or []), "label").agg(
        (loss / F.sum(F.col("pos") + F.col("neg"))).alias("log_loss"))


def roc_auc(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(label, pos, neg, auc): exact area, ties count one half, null with one class only.

    The counts below a score come from running totals over blocks of distinct scores, so no
    task sees all scores of a label.
    """
    return _roc_auc(score_counts(scored, by), by)


def _roc_auc(counts: DataFrame, by: list[str] | None) -> DataFrame:
    group = [*(by or []), "label"]
    per_score = counts.groupBy(*group, "prob").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__q"))
    seen = running_totals(per_score, ["prob"], {"__below": F.col("__q")}, within=group)
    wins = F.col("__p") * (F.col("__below") - F.col("__q") / 2.0)
    totals = seen.groupBy(*group).agg(F.sum("__p").alias("pos"), F.sum("__q").alias("neg"),
                                      F.sum(wins).alias("__w"))
    return totals.select(*group, "pos", "neg", F.try_divide(
        F.col("__w"), F.col("pos").cast("double") * F.col("neg")).alias("auc"))


def binned_roc_auc(scored: DataFrame, by: list[str] | None = None, bins: int = 10_000) -> DataFrame:
    """(label, pos, neg, auc, error_bound): the area from a histogram of scores in [0, 1], for tables of many
    distinct scores.

    Pairs of one bin count one half, so the exact area is at most ``error_bound`` away: half the share of pairs
    that meet in a bin. A task shuffles at most one row per label and bin, and histograms of parts can be added.
    """
    group = [*(by or []), "label"]
    at = F.least(F.floor(F.greatest(F.col("prob"), F.lit(0.0)) * bins), F.lit(bins - 1))
    counts = scored.groupBy(*group, at.alias("__bin")).agg(F.sum("y").alias("__p"), F.sum(1 - F.col("y")).alias("__q"))
    # at most ``bins`` rows per label
    before = Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("__below", F.coalesce(F.sum("__q").over(before), F.lit(0)))
    half = F.col("__p").cast("double") * F.col("__q") / 2
    totals = placed.groupBy(*group).agg(F.sum("__p").alias("pos"), F.sum("__q").alias("neg"), F.sum(half).alias("__half"),
                                        F.sum(F.col("__p").cast("double") * F.col("__below")).alias("__wins"))
    pairs = F.col("pos").cast("double") * F.col("neg")
    return totals.select(*group, "pos", "neg", F.try_divide(F.col("__wins") + F.col("__half"), pairs).alias("auc"),
                         F.try_divide(F.col("__half"), pairs).alias("error_bound"))


def roc_auc_weighted(auc: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Support-weighted and plain mean of the label areas, and the labels that have none."""
    known = F.col("auc").isNotNull()
    w = F.when(known, F.col("pos")).cast("double")
    return auc.groupBy(*(by or [])).agg(
        F.try_divide(F.sum(w * F.col("auc")), F.sum(w)).alias("roc_auc_weighted"),
        F.avg("auc").alias("roc_auc_macro"), F.count_if(~known).alias("labels_without_auc"))


def evaluate(scored: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """One row per group with the six scores of a multi-label classifier.

    Two readings of the score table: one grouped by row, one by distinct score.
    """
    by = by or []
    counts = pinned(score_counts(scored, by))
    per_label = precision_recall_f1(_confusion(counts, by))
    parts = [row_scores(scored, key, by), weighted_scores(per_label, by),
             roc_auc_weighted(_roc_auc(counts, by), by)]
    # one row per group on each side
    return reduce(lambda a, b: a.join(b, by) if by else a.join(F.broadcast(b)), parts)


def label_report(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per label with counts, scores, log loss and area, from one reading."""
    group = [*(by or []), "label"]
    counts = pinned(score_counts(scored, by))
    return (precision_recall_f1(_confusion(counts, by)).join(_log_loss_binary(counts, by), group)
            .join(_roc_auc(counts, by).select(*group, "auc"), group))
