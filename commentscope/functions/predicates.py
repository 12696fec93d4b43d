"""Row predicates and guarded arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentscope.functions.text import PUNCTUATION


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` where ``den > 0``, else 0.0 (safe under ANSI mode)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def label_sum(labels: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(l) for l in labels])


def any_label(labels: list[str]) -> Column:
    return label_sum(labels) > 0


def no_label(labels: list[str]) -> Column:
    return label_sum(labels) == 0


def is_scored(labels: list[str]) -> Column:
    """No label carries the -1 mark."""
    return reduce(lambda a, b: a & b, [F.col(l) != -1 for l in labels])


def none_label(labels: list[str]) -> Column:
    return F.lit(1) - (F.greatest(*labels) if len(labels) > 1 else F.col(labels[0]))


def threshold(p: Column, cut: float = 0.5) -> Column:
    return (p >= cut).cast("int")


def starts_with_letter(word: Column) -> Column:
    """True for words whose first character is one of a to z; a comparison of bytes, before any search or pattern."""
    return (word >= "a") & (word < "{")


def is_punctuation(word: Column) -> Column:
    """True for any contiguous piece of the punctuation string, the empty word included."""
    return ~starts_with_letter(word) & (F.instr(F.lit(PUNCTUATION), word) > 0)


def is_negative(compound: Column) -> Column:
    return (compound < -0.05).cast("int")
