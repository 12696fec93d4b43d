"""Label columns: attaching, filtering, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentscope.functions import predicates as P
from commentscope.plans.long_form import label_rows


def attach_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Columns of two tables over the same keys; an explicit key instead of row position."""
    return a.join(b, key, "inner")


def unmatched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Number of keys found on one side only; both are 0 for tables that belong together."""
    both = a.select(key, F.lit(1).alias("__a")).join(b.select(key, F.lit(1).alias("__b")), key, "full")
    return both.agg(F.count_if(F.col("__b").isNull()).alias("only_left"),
                    F.count_if(F.col("__a").isNull()).alias("only_right"))


def with_labels(comments: DataFrame, labels_table: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """Left join; a comment without a label row carries -1 in every label."""
    joined = comments.join(labels_table.select(key, *labels), key, "left")
    return joined.withColumns({l: F.coalesce(F.col(l), F.lit(-1)).cast("int") for l in labels})


def drop_unscored(df: DataFrame, labels: list[str]) -> DataFrame:
    return df.where(P.is_scored(labels))


def with_none_label(df: DataFrame, labels: list[str], name: str = "none") -> DataFrame:
    return df.withColumn(name, P.none_label(labels))


def drop_zero_scores(df: DataFrame, scores: str) -> DataFrame:
    """Rows whose scores are all zero are failed calls."""
    return df.where(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) != 0)


def label_totals(df: DataFrame, labels: list[str]) -> DataFrame:
    wide = df.agg(*[F.sum(l).cast("long").alias(l) for l in labels])
    return wide.unpivot([], labels, "label", "positives")


def label_class_counts(df: DataFrame, labels: list[str]) -> DataFrame:
    return label_rows(df, [], labels).groupBy("label", "y").agg(F.count(F.lit(1)).alias("n"))


def label_combinations(df: DataFrame, labels: list[str]) -> DataFrame:
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def clean_share(df: DataFrame, labels: list[str]) -> DataFrame:
    """Comments with a label, without one, and the share without."""
    none = P.no_label(labels)
    return df.agg(F.count_if(~none).alias("any_label"), F.count_if(none).alias("no_label"),
                  F.count(F.lit(1)).alias("total"),
                  F.round(F.count_if(none) * 100.0 / F.count(F.lit(1)), 3).alias("pct_none"))
