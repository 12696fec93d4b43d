"""A value computed once and used many times inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    An expression named inside a lambda is evaluated again for every element, and one named
    in several arms of a condition again for every arm; a lambda variable is not. Without
    this an index loop over an array is quadratic.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
