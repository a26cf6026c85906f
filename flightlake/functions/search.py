"""Ranks in sorted arrays by binary search, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F



def _search(values: Column, before: Callable[[Column], Column]) -> Column:
    """Number of leading entries of ``values`` for which ``before`` holds (it holds for a beginning of the array).

    A fold over the bits of the result, from the highest: a step is taken if the entry at its end still counts.
    ``values`` should be a column, not an expression: it is read at every step.
    """
    n = F.size(values)
    bits = F.ceil(F.log2(n + 1)).cast("int")
    steps = F.transform(F.sequence(F.lit(1), bits), lambda k: F.call_function("shiftleft", F.lit(1), bits - k))
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & before(F.get(values, at + step - 1)), at + step).otherwise(at))
    return F.when(n > 0, found).otherwise(F.lit(0))


def count_below(values: Column, score: Column) -> Column:
    """Entries of the ascending array ``values`` (no nulls) below ``score``; 0 for an empty or null array."""
    return _search(values, lambda v: v < score)


def count_at_or_below(values: Column, score: Column) -> Column:
    """Entries of the ascending array ``values`` (no nulls) at or below ``score``; 0 for an empty or null array."""
    return _search(values, lambda v: v <= score)
