"""Corpus exploration: frequencies, tf-idf, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.plans.long_form import exploded, label_rows
from commentscope.plans import quantiles as Q
from commentscope.plans.ordering import pinned


def top_k(df: DataFrame, measure: str, term: list[str], k: int) -> DataFrame:
    """Largest first, ties by term: a per-task top-k and one small merge."""
    return df.orderBy(F.desc(measure), *term).limit(k)


def frequencies(df: DataFrame, items: Column, names: list[str], count: str = "n") -> DataFrame:
    """Count the elements of an array column; structs are spread into their fields."""
    rows = exploded(df, [], items, "__i")
    fields = [F.col("__i").alias(names[0])] if len(names) == 1 else [F.col(f"__i.{n}") for n in names]
    return rows.select(*fields).groupBy(*names).agg(F.count(F.lit(1)).alias(count))


def content_frequencies(freq: DataFrame, stop_words: DataFrame, marks: DataFrame) -> DataFrame:
    """Without stop words and single punctuation marks."""
    return freq.join(stop_words, "word", "left_anti").join(marks, "word", "left_anti")


def top_words_per_label(df: DataFrame, tokens: Column, labels: list[str], k: int) -> DataFrame:
    """One pass for all labels; the rank limit is applied before the shuffle as well."""
    rows = label_rows(df.withColumn("__t", tokens), ["__t"], labels).where("y = 1")
    counts = (exploded(rows, ["label"], F.col("__t"), "word")
                  .groupBy("label", "word").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("label").orderBy(F.desc("n"), "word")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def category_lexicon(top: DataFrame, bad_words: DataFrame) -> DataFrame:
    """Frequent words of a label that are on the bad-word list."""
    return top.join(bad_words, "word", "left_semi").select("word", F.col("label").alias("category"))


def summary(long: DataFrame, key: str = "feature", value: str = "value", exact: bool = True) -> DataFrame:
    """count, mean, sample deviation, min, quartiles (exact or sketched), max per feature.

    The values are written once and read twice: one aggregate for the moments and the sketch, and for the exact
    quartiles a pass that shuffles only the values next to them. ``exact=False`` reads them once.
    """
    quarters = [0.25, 0.5, 0.75]
    rows = pinned(long.select(key, value).where(F.col(value).isNotNull())) if exact else long
    base = rows.groupBy(key).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"), *([Q.sketch(value, quarters).alias("__s")] if exact else []))
    if exact:
        base = pinned(base)
        spans = Q.brackets(F.col("__s"), F.col("count"), F.col("min"), F.col("max"), quarters)
        quartiles = Q.quantiles_in_brackets(rows, base.select(key, spans.alias("__brackets")), quarters, key, value)
    else:
        quartiles = Q.quantiles(rows, quarters, key, value, exact=False)
    return base.join(quartiles, key).select(
        key, "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
        F.col("q2").alias("p75"), "max")


def histogram(df: DataFrame, column: str, bins: int = 10, low: float | None = None,
              high: float | None = None) -> DataFrame:
    """(bin, lo, hi, n) with equal widths over the data or the given range; empty bins too."""
    x = F.col(column).cast("double")
    vals = df.select(x.alias("__x")).where("__x is not null")
    if low is None or high is None:
        limits = vals.agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    else:
        limits = df.sparkSession.range(1).select(F.lit(float(low)).alias("__lo"),
                                                 F.lit(float(high)).alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    # a column with one value gets a range of one around it
    limits = limits.select(
        F.when(F.col("__hi") > F.col("__lo"), F.col("__lo")).otherwise(F.col("__lo") - 0.5).alias("__lo"),
        F.when(F.col("__hi") > F.col("__lo"), F.col("__hi")).otherwise(F.col("__hi") + 0.5).alias("__hi"))
    inside = vals.join(F.broadcast(limits)).where("__x >= __lo and __x <= __hi")
    place = F.least(F.floor((F.col("__x") - F.col("__lo")) / width).cast("int"), F.lit(bins - 1))
    counts = inside.select(place.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = limits.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "__lo", "__hi")
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("__lo") + width * F.col("bin")).alias("lo"),
        (F.col("__lo") + width * (F.col("bin") + 1)).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _bandwidths(vals: DataFrame, key: str, value: str, points: int) -> DataFrame:
    """One row per key with at least two different values: number, bandwidth and grid."""
    stats = vals.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.stddev_samp(value).alias("__s"),
                                  F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    h = F.col("__s") * F.pow(F.col("__n").cast("double"), F.lit(-0.2))
    return (stats.where("__n > 1 and __s > 0").withColumn("__h", h)
                 .withColumn("__start", F.col("__lo") - 3 * F.col("__h"))
                 .withColumn("__step", (F.col("__hi") - F.col("__lo") + 6 * F.col("__h")) / (points - 1)))


ROOT_2_PI = 2.5066282746310002


def density(long: DataFrame, key: str, value: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density of a value per key at ``points`` grid positions.

    Equal values are counted first; the rows per grid point are summed before the shuffle,
    which carries one partial sum per task, key and grid point.
    Bandwidth: deviation times n^(-1/5); the grid spans the data plus three bandwidths.
    """
    vals = long.where(F.col(value).isNotNull())
    stats = _bandwidths(vals, key, value, points)
    counts = vals.groupBy(key, value).agg(F.count(F.lit(1)).alias("__c"))
    grid = F.sequence(F.lit(0), F.lit(points - 1))
    # one row per key on the right: labels or model columns
    rows = counts.join(F.broadcast(stats), key).select(
        key, "__n", "__h", "__start", "__step", F.col(value).alias("__x"), "__c",
        F.explode(grid).alias("point"))
    x = F.col("__start") + F.col("__step") * F.col("point")
    z = (x - F.col("__x")) / F.col("__h")
    # exp(-745) is the smallest double: beyond it the kernel is exactly zero
    part = F.col("__c") * F.exp(F.greatest(-0.5 * z * z, F.lit(-745.0)))
    return (rows.groupBy(key, "point").agg(
                F.first(x).alias("x"),
                (F.sum(part) / (F.first(F.col("__n") * F.col("__h")) * F.lit(ROOT_2_PI))).alias("density")))


#: Bandwidths from a cell beyond which its kernel is below the smallest difference of doubles from one.
REACH = 9.0


def binned_density(long: DataFrame, key: str, value: str, points: int = 50, tolerance: float = 1e-4) -> DataFrame:
    """``density`` from linear binning: each value is shared between the two nearest cells of a fine grid, and
    the kernel is summed over the cells.

    A cell is ``sqrt(8 * tolerance)`` bandwidths wide. Sharing replaces the kernel by its linear interpolation
    between cells, which is off by at most an eighth of the squared width times the largest second derivative;
    for the Gaussian kernel that is ``tolerance`` times its peak, so a density is off by at most
    ``tolerance / (bandwidth * sqrt(2 * pi))``. The shuffle carries one row per key and occupied cell, whatever
    the number of distinct values, and only grid points within reach of a cell meet it.
    """
    vals = long.where(F.col(value).isNotNull())
    # one row per key on the right of both joins: labels or model columns
    stats = F.broadcast(pinned(_bandwidths(vals, key, value, points).withColumn("__width", F.col("__h") * F.sqrt(F.lit(8 * tolerance)))))
    at = (F.col(value) - F.col("__lo")) / F.col("__width")
    cells = (vals.select(key, value).join(stats, key).select(key, F.floor(at).alias("__cell"), (at - F.floor(at)).alias("__far"))
             .groupBy(key, "__cell").agg(F.sum(1 - F.col("__far")).alias("__near"), F.sum("__far").alias("__far")))
    placed = cells.join(stats, key).withColumn("__x", F.col("__lo") + F.col("__cell") * F.col("__width"))
    first = F.greatest(F.ceil((F.col("__x") - REACH * F.col("__h") - F.col("__start")) / F.col("__step")), F.lit(0))
    last = F.least(F.floor((F.col("__x") + F.col("__width") + REACH * F.col("__h") - F.col("__start")) / F.col("__step")), F.lit(points - 1))
    reached = placed.withColumns({"__first": first, "__last": last}).where("__first <= __last")
    rows = reached.select("*", F.explode(F.sequence(F.col("__first").cast("int"), F.col("__last").cast("int"))).alias("point"))

    def kernel(cell_at: Column) -> Column:
        z = (F.col("__start") + F.col("__step") * F.col("point") - cell_at) / F.col("__h")
        return F.exp(-0.5 * z * z)

    part = F.col("__near") * kernel(F.col("__x")) + F.col("__far") * kernel(F.col("__x") + F.col("__width"))
    sums = rows.groupBy(key, "point").agg(F.sum(part).alias("__sum"))
    frame = stats.select(key, "__n", "__h", "__start", "__step", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    return frame.join(sums, [key, "point"], "left").select(
        key, "point", (F.col("__start") + F.col("__step") * F.col("point")).alias("x"),
        (F.coalesce("__sum", F.lit(0.0)) / (F.col("__n") * F.col("__h") * F.lit(ROOT_2_PI))).alias("density"))


def sentiment_buckets(df: DataFrame, compound: str, by: list[str] | None = None) -> DataFrame:
    """Counts and shares below -0.05, above 0.05 and strictly between; the rest is shown."""
    c, n = F.col(compound), F.count(F.lit(1))
    parts = {"negative": c < -0.05, "positive": c > 0.05, "neutral": (c > -0.05) & (c < 0.05)}
    out = df.groupBy(*(by or [])).agg(
        *[F.count_if(cond).alias(name) for name, cond in parts.items()], n.alias("total"))
    return out.select(
        *(by or []), *parts, "total",
        (F.col("total") - F.col("negative") - F.col("positive") - F.col("neutral")).alias("remainder"),
        *[F.try_divide(F.col(p).cast("double"), F.col("total")).alias(f"{p}_share") for p in parts])


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Contingency table of two 0/1 columns."""
    return df.groupBy(row).agg(F.count_if(F.col(column) == 0).alias(f"{column}_0"),
                               F.count_if(F.col(column) == 1).alias(f"{column}_1"))
