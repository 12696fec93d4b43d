"""Feature selection and scaling. Long tables are (feature, value, labels...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.plans import moments
from commentscope.plans.ordering import pinned
from commentscope.plans.quantiles import quantiles


def label_correlation(long: DataFrame, labels: list[str]) -> DataFrame:
    """(feature, label, r): Pearson r of every feature with every label in one pass.

    All moments of a pair are taken over the rows where both are known. A constant feature or
    label gives null, not an error.
    """
    x, aggs = F.col("value").cast("double"), []
    for l in labels:
        y = F.col(l).cast("double")
        both = x.isNotNull() & y.isNotNull()
        px, py = F.when(both, x), F.when(both, y)
        aggs += [F.covar_pop(px, py).alias(f"__c_{l}"), F.stddev_pop(px).alias(f"__x_{l}"), F.stddev_pop(py).alias(f"__y_{l}"),
                 (F.min(px) < F.max(px)).alias(f"__vx_{l}"), (F.min(py) < F.max(py)).alias(f"__vy_{l}")]
    agg = long.groupBy("feature").agg(*aggs)
    r = lambda l: F.when(F.col(f"__vx_{l}") & F.col(f"__vy_{l}"),
                         F.try_divide(F.col(f"__c_{l}"), F.col(f"__x_{l}") * F.col(f"__y_{l}")))
    return agg.select("feature", *[r(l).alias(l) for l in labels]).unpivot(
        ["feature"], labels, "label", "r")


def vector_label_correlation(df: DataFrame, vector: str | Column, names: list[str], labels: list[str]) -> DataFrame:
    """(feature, label, r): ``label_correlation`` for features that are the entries of an array column, named in
    order. One pass adds matrices of sums per task; there is no row per entry."""
    v = F.col(vector) if isinstance(vector, str) else vector
    rows = df.select(v.alias("__x"), F.array(*[F.col(l).cast("double") for l in labels]).alias("__y"))
    found = moments.correlations(rows, "__x", len(names), "__y", len(labels))
    return found.select(moments.entry_names(names, "i").alias("feature"), moments.entry_names(labels, "j").alias("label"), "r")


def correlation_filter(correlations: DataFrame, cut: float) -> DataFrame:
    """(feature, max_abs_r) with the largest absolute r strictly above the cut."""
    best = correlations.groupBy("feature").agg(F.max(F.abs("r")).alias("max_abs_r"))
    return best.where(F.col("max_abs_r") > cut)


def useful_ratio(correlations: DataFrame, cut: float) -> DataFrame:
    """Share of the features the filter keeps."""
    best = correlations.groupBy("feature").agg(F.max(F.abs("r")).alias("m"))
    return best.agg(F.count_if(F.col("m") > cut).alias("kept"), F.count(F.lit(1)).alias("total")).select(
        "kept", "total", (F.col("kept") / F.col("total")).alias("ratio"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) for all pairs of columns, over the rows where both are known; null for a constant column.

    Each task sums blocks of pairs; the blocks are added and turned into rows on the executors."""
    rows = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("__v"))
    return moments.correlations(rows, "__v", len(columns)).select(
        moments.entry_names(columns, "i").alias("a"), moments.entry_names(columns, "j").alias("b"), "r")


#: Features that a round of ``drop_collinear`` settles.
ROUND = 1024


def drop_collinear(matrix: DataFrame, strength: DataFrame, cut: float, block: int = ROUND) -> DataFrame:
    """(feature, max_abs_r, kept): features in order of strength; one is dropped when it correlates above
    the cut with a kept one.

    Only pairs above the cut count. A round settles ``block`` ranks: it reads which of them clash with features kept
    in earlier rounds, one row each, and the clashes among them, at most a square of the block, and goes through
    these in order.
    """
    names = [(r["feature"], r["max_abs_r"]) for r in strength.orderBy(F.desc_nulls_last("max_abs_r"), "feature").collect()]  # one row per feature
    spark = strength.sparkSession
    place = spark.createDataFrame([(f, i) for i, (f, _) in enumerate(names)], "feature string, rank int")
    clashes = matrix.where((F.col("a") != F.col("b")) & (F.abs("r") > cut)).select("a", "b")
    stronger = pinned(clashes.join(place.select(F.col("feature").alias("a"), "rank"), "a")
                      .join(place.select(F.col("feature").alias("b"), F.col("rank").alias("rank_b")), "b").where("rank_b < rank").select("rank", "rank_b"))
    kept: list[int] = []
    for first in range(0, len(names), block):
        own = stronger.where(F.col("rank").between(first, first + block - 1))
        before = own.where(F.col("rank_b") < first)
        if kept and first:
            known = spark.createDataFrame([(i,) for i in kept], "rank_b int")
            dropped = {r["rank"] for r in before.join(known, "rank_b", "left_semi").select("rank").distinct().collect()}
        else:
            dropped = set()
        among: dict[int, list[int]] = {}
        for r in own.where(F.col("rank_b") >= first).collect():
            among.setdefault(r["rank"], []).append(r["rank_b"])
        here: set[int] = set()
        for i in range(first, min(first + block, len(names))):
            if i not in dropped and here.isdisjoint(among.get(i, [])):
                here.add(i)
        kept += sorted(here)
    chosen = set(kept)
    return spark.createDataFrame([(f, m, i in chosen) for i, (f, m) in enumerate(names)], "feature string, max_abs_r double, kept boolean")


def fit_minmax(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the smallest and largest value of each column."""
    return df.agg(*[f(c).cast("double").alias(f"__{n}_{c}")
                    for c in columns for n, f in (("min", F.min), ("max", F.max))])


def apply_minmax(df: DataFrame, limits: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """(x - min) / (max - min) with the fitted limits; no clipping; a constant column gives x - min."""
    def scaled(c: str) -> Column:
        width = F.col(f"__max_{c}") - F.col(f"__min_{c}")
        return (F.col(c) - F.col(f"__min_{c}")) / F.when(width > 0, width).otherwise(1.0)

    # exactly one row on the right
    wide = df.join(F.broadcast(limits))
    return wide.select(*df.columns, *[scaled(c).alias(f"{c}{suffix}") for c in columns])


def mutual_information(long: DataFrame, labels: list[str], bins: int = 10, exact: bool = True) -> DataFrame:
    """(feature, label, mi): mutual information in nats with quantile bins of the feature.

    The inner bin edges are quantiles, exact or sketched; a value belongs to the bin numbered by the
    edges below it, so equal values share a bin.
    """
    edges = quantiles(long.select("feature", "value"), [i / bins for i in range(1, bins)], exact=exact)
    arr = edges.select("feature", F.array(*[f"q{i}" for i in range(bins - 1)]).alias("__edges"))
    # one row per model column on the right
    binned = long.join(F.broadcast(arr), "feature").withColumn(
        "bin", F.size(F.filter(F.array_append("__edges", F.col("value")), lambda e: e < F.col("value"))))
    pairs = F.array(*[F.struct(F.lit(l).alias("label"), F.col(l).cast("int").alias("y")) for l in labels])
    joint = (binned.groupBy("feature", "bin", *labels).agg(F.count(F.lit(1)).alias("c"))
                   .select("feature", "bin", "c", F.explode(pairs).alias("p"))
                   .groupBy("feature", F.col("p.label").alias("label"), "bin", F.col("p.y").alias("y"))
                   .agg(F.sum("c").alias("c")))
    # from here on at most bins x 2 rows per feature and label
    part = lambda *by: F.sum("c").over(Window.partitionBy("feature", "label", *by))
    terms = joint.select("feature", "label", "c", part().alias("n"), part("bin").alias("cx"),
                         part("y").alias("cy"))
    c, n = F.col("c"), F.col("n")
    mi = F.sum(c / n * F.log(c * n / (F.col("cx") * F.col("cy"))))
    return terms.groupBy("feature", "label").agg(mi.alias("mi"))


def top_per_label(scores: DataFrame, measure: str, k: int = 50) -> DataFrame:
    """The k best features of each label with their rank."""
    w = Window.partitionBy("label").orderBy(F.desc(measure), "feature")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def intersect_features(top: DataFrame, selected: DataFrame) -> DataFrame:
    """(label, shared): how many selected features are among each label's best."""
    return (top.join(selected.select("feature"), "feature", "left_semi")
               .groupBy("label").agg(F.count(F.lit(1)).alias("shared")))


def vote_counts(top: DataFrame) -> DataFrame:
    """(feature, votes): in how many labels' best lists a feature stands."""
    return top.groupBy("feature").agg(F.count(F.lit(1)).alias("votes"))


def feature_status(features: DataFrame, selected: DataFrame, top: DataFrame,
                   minority: list[str]) -> DataFrame:
    """(feature, status): selected before minority before other."""
    chosen = selected.select("feature").distinct().withColumn("__sel", F.lit(True))
    rare = (top.where(F.col("label").isin(minority)).select("feature").distinct()
               .withColumn("__min", F.lit(True)))
    status = (F.when(F.col("__sel"), "selected").when(F.col("__min"), "minority").otherwise("other"))
    return (features.select("feature").distinct().join(chosen, "feature", "left")
                    .join(rare, "feature", "left").select("feature", status.alias("status")))


def model_table(rows: DataFrame, labels: DataFrame, key: str, label_names: list[str], features: list[str], scaled: list[str],
                vector: str, width: int, cut: float) -> tuple[DataFrame, list[str]]:
    """(table, kept dimensions): labelled and unlabelled rows in one table (key, labelled, the columns of ``labels``,
    features, kept vector dimensions).

    The limits of the ``scaled`` features and the choice of dimensions, those whose absolute correlation with a label
    exceeds ``cut``, are fitted on the labelled rows and applied to all. Rows are written once.
    """
    known = labels.withColumn("labelled", F.lit(1))
    marked = pinned(rows.join(known, key, "left").withColumn("labelled", F.coalesce("labelled", F.lit(0)))
                    .withColumn(vector, F.transform(vector, lambda x: F.round(x, 6))))
    train = marked.where("labelled = 1")
    names = [f"d{i}" for i in range(width)]
    strong = correlation_filter(vector_label_correlation(train, vector, names, label_names), cut)
    found = {r["feature"] for r in strong.select("feature").collect()}  # one row per dimension at most
    kept = [n for n in names if n in found]
    table = apply_minmax(marked, fit_minmax(train, scaled), scaled)
    chosen = [F.get(vector, F.lit(i)).alias(n) for i, n in enumerate(names) if n in found]
    order = [f"{c}_scaled" if c in scaled else c for c in features]
    return table.select(key, "labelled", *[c for c in labels.columns if c != key], *order, *chosen), kept
