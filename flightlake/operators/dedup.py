"""Last-wins de-duplication (A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: Sequence[str], value: str, order: Column,
              first_seen: str = "first_seen") -> DataFrame:
    """One row per key: the ``value`` of the last row by ``order`` and the first ``order``.

    Equivalent to overwriting a dictionary while scanning rows in order and
    listing keys in order of first appearance; runs as a partial/final aggregate.
    """
    return df.groupBy(*keys).agg(F.max_by(F.col(value), order).alias(value),
                                 F.min(order).alias(first_seen))
