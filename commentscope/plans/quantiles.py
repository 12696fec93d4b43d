"""Exact quantiles by selection: a sketch brackets each one, a filtered pass settles it.

One aggregate sketches every key. The sketch's rank error is bounded, so the values a little below and above
a quantile bracket it. A second pass counts equal values inside the brackets and, per key, how many values lie
between two brackets; only these counts are shuffled, whatever the number of distinct values outside. Running
totals over them give the value at every rank. A key whose rank a bracket should miss is settled over all its
distinct values instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentscope.plans.ordering import pinned, running_totals

#: A sketched quantile is at most n / ACCURACY ranks off; a bracket reaches MARGIN times as far.
ACCURACY, MARGIN = 10_000, 3


def sketch(value: str, probs: list[float]) -> Column:
    """The aggregate from which ``brackets`` are made: quantiles a little below and above each one asked for."""
    step = MARGIN / ACCURACY
    around = [min(1.0, max(0.0, p + side * step)) for p in probs for side in (-1, 1)]
    return F.percentile_approx(value, around, ACCURACY)


def brackets(sketched: Column, n: Column, low: Column, high: Column, probs: list[float]) -> Column:
    """(lo, hi) per quantile. With so few values that a bracket could be less than one rank wide it spans them all."""
    few = n < ACCURACY
    return F.array(*[F.struct(F.when(few, low).otherwise(F.get(sketched, F.lit(2 * i))).alias("lo"),
                              F.when(few, high).otherwise(F.get(sketched, F.lit(2 * i + 1))).alias("hi")) for i in range(len(probs))])


def quantiles_in_brackets(long: DataFrame, bracketed: DataFrame, probs: list[float], key: str = "feature", value: str = "value") -> DataFrame:
    """(key, n, q0, q1, ...) from (key, __brackets); the probabilities ascend."""
    v = F.col(value)
    ends = [F.get("__brackets", F.lit(i))[side].alias(f"__{side}{i}") for i in range(len(probs)) for side in ("lo", "hi")]
    # one row per key on the right: labels or model columns
    rows = long.where(v.isNotNull()).select(key, value).join(F.broadcast(bracketed.select(key, *ends)), key)
    inside = reduce(lambda a, b: a | b, [(F.col(f"__lo{i}") <= v) & (v <= F.col(f"__hi{i}")) for i in range(len(probs))])
    # values with the same number of brackets below them are either before the next bracket or in it
    gap = reduce(lambda a, b: a + b, [(F.col(f"__hi{i}") < v).cast("int") for i in range(len(probs))])
    counts = (rows.select(key, gap.alias("__gap"), F.when(inside, v).alias(value))
              .groupBy(key, "__gap", value).agg(F.count(F.lit(1)).alias("__c")))
    found = quantiles_of_counts(pinned(counts), probs, key, value, ["__gap", value])
    missed = found.where(reduce(lambda a, b: a | b, [F.col(f"q{i}").isNull() for i in range(len(probs))])).select(key)
    if missed.head(1):
        whole = value_counts(long.join(F.broadcast(missed), key, "left_semi"), key, value)
        found = found.join(F.broadcast(missed), key, "left_anti").unionByName(quantiles_of_counts(whole, probs, key, value, [value]))
    return found


def exact_quantiles(long: DataFrame, probs: list[float], key: str = "feature", value: str = "value") -> DataFrame:
    """(key, n, q0, q1, ...): linearly interpolated quantiles, nulls ignored. The table is read twice."""
    order = sorted(range(len(probs)), key=probs.__getitem__)
    ascending = [float(probs[i]) for i in order]
    low, high = F.min(value), F.max(value)
    stats = long.where(F.col(value).isNotNull()).groupBy(key).agg(
        F.count(value).alias("n"), low.alias("lo"), high.alias("hi"), sketch(value, ascending).alias("s"))
    bracketed = stats.select(key, brackets(F.col("s"), F.col("n"), F.col("lo"), F.col("hi"), ascending).alias("__brackets"))
    found = quantiles_in_brackets(long, bracketed, ascending, key, value)
    return found.select(key, "n", *[F.col(f"q{order.index(i)}").alias(f"q{i}") for i in range(len(probs))])


def value_counts(long: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, __c): how often each value occurs, written once. What feeds it is computed one time."""
    return pinned(long.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__c")))


def quantiles_of_counts(counts: DataFrame, probs: list[float], key: str, value: str, order: list[str]) -> DataFrame:
    """Quantiles from counts of values; a count without a value stands for values that are not asked for."""
    seen = running_totals(counts, order, {"__upto": F.col("__c")}, within=[key])
    sizes = counts.groupBy(key).agg(F.sum("__c").alias("n"))
    placed = seen.join(sizes, key).withColumn("__from", F.col("__upto") - F.col("__c"))

    picks, out = [], []
    for i, p in enumerate(probs):
        at = (F.col("n") - 1) * F.lit(float(p))
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("__from") <= pos) & (pos < F.col("__upto"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"__{side}{i}"))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(f"q{i}"))
    return placed.groupBy(key, "n").agg(*picks).select(key, "n", *out)


def quantiles(long: DataFrame, probs: list[float], key: str = "feature", value: str = "value", exact: bool = True) -> DataFrame:
    """Exact quantiles, or one pass with a sketch of fixed size per key that errs by at most one ten-thousandth
    of the rank."""
    if exact:
        return exact_quantiles(long, probs, key, value)
    approximate = F.percentile_approx(value, [float(p) for p in probs], ACCURACY)
    out = long.groupBy(key).agg(F.count(value).alias("n"), approximate.alias("__q"))
    return out.select(key, "n", *[F.col("__q")[i].alias(f"q{i}") for i in range(len(probs))])
