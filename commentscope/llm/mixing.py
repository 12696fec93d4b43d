"""Mixing sources to target weights by entropy balancing, with DataFrame operations alone.

The rates r of the documents minimise ``sum size * (r log(r / q) - r + q)`` under one token
constraint per source, ``sum size * r = target``, and ``r <= cap``; q is a base rate, 1 unless a
column gives it. The solution is exponentially tilted, ``r = min(cap, q * exp(t))`` with one
multiplier t per source, and the multipliers minimise the convex dual. Newton steps on the dual,
kept in a bracket, run over sums per source and base rate, so each step reads a small table.

Rates become whole copies by systematic rounding along the documents of a source in order of size;
then at most ``MENDS`` documents per source take one copy more or less to close the gap that is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.llm.common import broadcast_if_small, quoted, row_name, written
from commentscope.plans.ordering import pinned

WORD = r"[^\x20\x09-\x0D]+"
#: Parts of a copy: rates are rounded to this, so running totals are exact whole numbers.
UNIT = 100_000_000
#: Newton steps at most; a step past the tolerance ends the loop.
STEPS = 60
TOLERANCE = 1e-13
#: Documents per source that may be moved by one copy after rounding.
MENDS = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(quoted(text)).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(source, source_size, target): sources in code-point order, null last, share all sizes by the
    repeating weights; a target stops at ``cap`` times its source and the excess is shared again.

    Works on one row per source. With sources in order of ``cap * size / weight``, a level c solves
    ``sum min(cap * size, c * weight) = total``; those before the crossing are full.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
    full = (F.col("source_size") * cap).cast("double")
    order = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    filled = F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    every = Window.partitionBy()
    per = per.withColumn("level", (F.sum("source_size").over(every) - filled) / rest).withColumn("full", full)
    per = per.withColumn("open", F.col("level") * F.col("weight") <= F.col("full"))
    level = F.max(F.when(F.col("open"), F.col("level"))).over(every)
    return per.select("source", "source_size",
                      F.when(F.col("open"), F.least(level * F.col("weight"), F.col("full"))).otherwise(F.col("full")).alias("target"))


def multipliers(moments: DataFrame, goals: DataFrame, cap: int) -> DataFrame:
    """(source, tilt) by Newton steps on the dual; ``moments`` has the tokens of each source and base rate.

    A step: gradient ``g - target`` with ``g = sum tokens * min(cap, q e^t)``, curvature the part of g
    below the cap. Where the curvature is zero or a step leaves the bracket, the bracket is halved.
    """
    state = pinned(goals.select("source", "target", F.lit(0.0).alias("tilt"), F.lit(-50.0).alias("low"), F.lit(50.0).alias("high"),
                                F.lit(False).alias("done")))
    tilted = F.col("base") * F.exp("tilt")
    for _ in range(STEPS):
        sums = (moments.withColumnRenamed("source", "own").join(state, F.col("own").eqNullSafe(F.col("source")), "right")
                .groupBy("source", "target", "tilt", "low", "high", "done")
                .agg(F.coalesce(F.sum(F.col("tokens") * F.least(F.lit(float(cap)), tilted)), F.lit(0.0)).alias("got"),
                     F.coalesce(F.sum(F.when(tilted < cap, F.col("tokens") * tilted)), F.lit(0.0)).alias("curve")))
        gap = F.col("got") - F.col("target")
        near = F.abs(gap) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - gap / F.when(F.col("curve") > 0, F.col("curve"))
        inside = (step > low) & (step < high)
        state = pinned(sums.select(
            "source", "target",
            F.when(near, F.col("tilt")).when(inside, step).otherwise((low + high) / 2).alias("tilt"),
            low.alias("low"), high.alias("high"),
            (near | (high - low < 1e-15)).alias("done")))
        if not state.where(~F.col("done")).head(1):
            break
    return state.select("source", "tilt")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", base_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, tag (the md5 of the text), size, source, source_size,
    target, rate, copies, taken.

    Size counts words; a null text has none. Null sources are one source, the last. Null ids and
    repeated rows are documents of their own. A source without words has target 0 and takes nothing.
    Other columns are ignored; an empty table gives no rows. Reruns agree: order is by source, size,
    md5 of the id, and id; rows equal in all of these are equal in the result up to their order.
    """
    base = F.coalesce(F.col(quoted(base_col)).cast("double"), F.lit(1.0)) if base_col else F.lit(1.0)
    sizes = written(docs.select(
        F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(source_col)).cast("string").alias("source"), word_count(text_col).alias("size"),
        row_name(id_col, text_col)[1].alias("tag"), base.alias("base"), F.md5(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit(""))).alias("draw")), "sizes")
    moments = pinned(sizes.groupBy("source", "base").agg(F.sum("size").cast("double").alias("tokens")))
    goals = pinned(targets(sizes, weights, cap))
    tilts = multipliers(moments, goals, cap)
    per_source = pinned(goals.withColumnRenamed("source", "own").join(tilts, F.col("own").eqNullSafe(F.col("source"))).drop("own"))
    rated = (sizes.withColumnRenamed("source", "own")
             .join(broadcast_if_small(per_source), F.col("own").eqNullSafe(F.col("source"))).drop("own")
             .withColumn("rate", F.when(F.col("target") > 0, F.least(F.lit(float(cap)), F.col("base") * F.exp("tilt"))).otherwise(0.0))
             .withColumn("units", F.round(F.col("rate") * UNIT).cast("long"))
             .withColumn("whole", F.floor(F.col("units") / UNIT))
             .withColumn("part", F.col("units") - F.col("whole") * UNIT))
    # numbered once, where the rows are written: rows may be equal in all else
    out = written(_rounded(rated, cap).withColumn("row", F.monotonically_increasing_id()), "copies")
    for _ in range(MENDS):
        out = _mended(out, cap)
    return out.select("doc_id", "tag", "size", "source", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def _rounded(rated: DataFrame, cap: int) -> DataFrame:
    """Systematic rounding: the running total of parts, in order of size, passes half a copy at each extra one.

    No window holds a source: totals per size come first, then per first hex digits of the draw,
    then rows inside one such cell.
    """
    rated = rated.withColumn("cell", F.substring("draw", 1, 3))
    cells = rated.groupBy("source", "size", "cell").agg(F.sum("part").alias("parts"))
    sizes = cells.groupBy("source", "size").agg(F.sum("parts").alias("parts"))
    def before(window):
        return F.coalesce(F.sum("parts").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sizes = sizes.select("source", "size", before(Window.partitionBy("source").orderBy("size")).alias("size_before"))
    cells = cells.select("source", "size", "cell", before(Window.partitionBy("source", "size").orderBy("cell")).alias("cell_before"))
    inside = (Window.partitionBy("source", "size", "cell").orderBy("draw", F.col("doc_id").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rated.withColumn("inside", F.sum("part").over(inside))
    for table, keys in ((cells, ["source", "size", "cell"]), (sizes, ["source", "size"])):
        table = table.select(*[F.col(k).alias("k_" + k) for k in keys], F.col(table.columns[-1]))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col("k_" + k))
        rows = rows.join(table, on).drop(*["k_" + k for k in keys])
    upto = F.col("inside") + F.col("cell_before") + F.col("size_before") + UNIT // 2
    extra = F.floor(upto / UNIT) - F.floor((upto - F.col("part")) / UNIT)
    return rows.select("doc_id", "tag", "source", "size", "draw", "source_size", "target", "rate",
                       F.least(F.col("whole") + extra, F.lit(cap)).cast("long").alias("copies"))


def _mended(rows: DataFrame, cap: int) -> DataFrame:
    """Move one document per source by one copy where that brings the source nearer to its target."""
    gaps = rows.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("now"))
    gaps = pinned(gaps.select(F.col("source").alias("g_source"), (F.col("target") - F.col("now")).alias("gap")))
    near = (rows.join(broadcast_if_small(gaps), F.col("source").eqNullSafe(F.col("g_source")))
            .where(F.col("doc_id").isNotNull())
            .where(F.when(F.col("gap") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0))
            .withColumn("left", F.abs(F.abs("gap") - F.col("size")))
            .where(F.col("left") < F.abs("gap")))
    best = near.groupBy(F.col("g_source")).agg(
        F.min(F.struct("left", "size", "draw", "tag", "copies", "row")).alias("best"), F.first(F.signum("gap")).alias("sign"))
    best = pinned(best.select(F.col("best.row").alias("b_row"), "sign"))
    on = F.col("row") == F.col("b_row")
    moved = F.greatest(F.lit(0), F.least(F.lit(cap), F.col("copies") + F.coalesce("sign", F.lit(0.0))))
    return rows.join(broadcast_if_small(best), on, "left").withColumn("copies", moved.cast("long")).select(*rows.columns)
