"""Exact row numbers and running totals without a single-task window.

A window over a whole table runs in one task. Here the rows are range-partitioned by
their order and written to the checkpoint folder together with the number of their block;
every block is then summed on its own, and the totals of the blocks before it (one row
per block) are added. The checkpoint pins the block numbers: a lost executor re-reads
them and cannot draw other boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentscope.session import ensure_checkpoint_dir

BLOCK = "__block"


def pinned(df: DataFrame) -> DataFrame:
    """The table read back from the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_blocks(df: DataFrame, order: list[str]) -> DataFrame:
    return pinned(df.repartitionByRange(*order).withColumn(BLOCK, F.spark_partition_id()))


def running_totals(df: DataFrame, order: list[str], totals: dict[str, Column],
                   within: list[str] | None = None) -> DataFrame:
    """Add, for each entry of ``totals``, its sum over all rows up to and including this one.

    ``order`` must be unique inside ``within``; ties are to be aggregated or broken before.
    """
    within = within or []
    blocks = in_blocks(df, [*within, *order])
    per_block = blocks.groupBy(*within, BLOCK).agg(
        *[F.sum(c).alias(f"__sum_{name}") for name, c in totals.items()])
    # one row per block and group: at most the number of shuffle partitions plus groups
    before = Window.partitionBy(*within).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(*within, BLOCK, *[
        F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__before_{name}")
        for name in totals])
    inside = (Window.partitionBy(*within, BLOCK).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = blocks.select("*", *[F.sum(c).over(inside).alias(f"__inside_{name}")
                                 for name, c in totals.items()])
    out = local.join(offsets, [*within, BLOCK])
    return out.select(*df.columns, *[
        (F.col(f"__inside_{name}") + F.col(f"__before_{name}")).alias(name) for name in totals])


def row_numbers(df: DataFrame, order: list[str], name: str = "rn",
                within: list[str] | None = None) -> DataFrame:
    """Add row numbers from 1 in a total order."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, within)
