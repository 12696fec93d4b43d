"""Folds, validation splits, oversampling and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentscope.plans.ordering import row_numbers


def kfold_contiguous(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """(key, fold): k blocks in key order, the first n mod k one row longer."""
    numbered = row_numbers(df.select(key), [key])
    # exactly one row on the right
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    rows = numbered.join(F.broadcast(n))
    size, longer, at = F.expr(f"__n div {k}"), F.col("__n") % k, F.col("rn") - 1
    head = longer * (size + 1)
    fold = F.when(at < head, F.floor(at / (size + 1))).otherwise(
        longer + F.floor((at - head) / F.greatest(size, F.lit(1))))
    return rows.select(key, fold.cast("int").alias("fold"))


def kfold_shuffled(df: DataFrame, key: str, k: int = 5, seed: int = 0) -> DataFrame:
    """Add a fold drawn from a hash of the key: repeatable and without a shuffle."""
    first = F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8)
    return df.withColumn("fold", F.pmod(F.conv(first, 16, 10).cast("long"), F.lit(k)).cast("int"))


def tail_split(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, is_validation): the last rows in key order are the validation part."""
    numbered = row_numbers(df.select(key), [key])
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    cut = F.floor(F.col("__n") * F.lit(1.0 - share))
    return numbered.join(F.broadcast(n)).select(key, (F.col("rn") > cut).cast("int").alias("is_validation"))


def random_oversample(df: DataFrame, key: str, label: str, ratio: float = 0.5) -> DataFrame:
    """Repeat minority rows until they are ``ratio`` times the majority; originals stay.

    Copies are spread evenly: every minority row is repeated the same number of times and
    the first rows in key order once more. Column ``copy`` is 0 for originals; (key, copy)
    stays unique, so the operator can be applied for one label after the other.
    """
    base = df if "copy" in df.columns else df.withColumn("copy", F.lit(0).cast("long"))
    ones, total, top = base.agg(F.count_if(F.col(label) == 1), F.count(F.lit(1)), F.max("copy")).first()
    zeros = total - ones
    minority, m = (1, ones) if ones <= zeros else (0, zeros)
    need = int(ratio * (total - m)) - m
    if m == 0 or need <= 0:
        return base
    each, more, stride = need // m, need % m, top + 1
    rows = base.where(F.col(label) == minority)
    numbers = row_numbers(rows.select(key, "copy"), [key, "copy"])
    times = numbers.select(key, "copy", (F.lit(each) + F.when(F.col("rn") <= more, 1).otherwise(0)).alias("__t"))
    copies = (rows.join(times.where("__t > 0"), [key, "copy"])
                  .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__t").cast("int"))))
                  .withColumn("copy", F.col("copy") + F.col("__i") * F.lit(stride))
                  .select(*base.columns))
    return base.unionByName(copies)


def leak_free_fold(df: DataFrame, key: str, label: str, folds: DataFrame, fold: int,
                   ratio: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Training part without the fold, oversampled; test part as it is."""
    tagged = df.join(folds, key)
    train = random_oversample(tagged.where(F.col("fold") != fold), key, label, ratio)
    return train, tagged.where(F.col("fold") == fold)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).orderBy("y")


def class_weights(rows: DataFrame) -> DataFrame:
    """Weights per label from (label, y): balanced, and the ratio and root ratio of classes."""
    agg = rows.groupBy("label").agg(F.count_if(F.col("y") == 1).alias("pos"),
                                    F.count_if(F.col("y") == 0).alias("neg"))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    scale = F.try_divide(neg, pos)
    return agg.select("label", F.try_divide(pos + neg, 2 * neg).alias("weight_0"),
                      F.try_divide(pos + neg, 2 * pos).alias("weight_1"),
                      scale.alias("scale_pos_weight"), F.sqrt(scale).alias("sqrt_scale_pos_weight"))


def with_balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add n / (2 n_class) per row for weighted fits."""
    n = df.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(label) == 1).alias("__p"))
    size = F.when(F.col(label) == 1, F.col("__p")).otherwise(F.col("__n") - F.col("__p"))
    return df.join(F.broadcast(n)).withColumn(name, F.col("__n") / (2.0 * size)).drop("__n", "__p")
