"""Wide to long form: many columns aggregated in one pass over one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_columns(df: DataFrame, ids: list[str], columns: list[str], key: str = "feature",
                    value: str = "value") -> DataFrame:
    as_double = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return as_double.unpivot(ids, columns, key, value)


def unpivot_vector(df: DataFrame, ids: list[str], vector: str, key: str = "feature",
                   value: str = "value", prefix: str = "d") -> DataFrame:
    """One row per vector position, named d0, d1, ..."""
    return (df.select(*ids, F.posexplode(vector).alias("__pos", "__x"))
              .select(*ids, F.concat(F.lit(prefix), F.col("__pos")).alias(key),
                      F.col("__x").cast("double").alias(value)))


def label_rows(df: DataFrame, ids: list[str], labels: list[str]) -> DataFrame:
    """(ids, label, y): one scan serves every label."""
    pairs = F.array(*[F.struct(F.lit(l).alias("label"), F.col(l).cast("int").alias("y"))
                      for l in labels])
    return df.select(*ids, F.explode(pairs).alias("__l")).select(*ids, "__l.label", "__l.y")


def rounded(c: Column, places: int = 6) -> Column:
    return F.round(c, places) + F.lit(0.0)


def exploded(df: DataFrame, keep: list, array: Column, name: str) -> DataFrame:
    """One row per element, rows without elements left out.

    A plain explode makes the optimizer add a filter on the size of the array, which is
    pushed below the projection and computes the array twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
