"""Flattening of nested payload columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_by_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """One ``select`` of nested paths renamed by ``mapping`` (path -> flat name)."""
    return df.select(*[F.col(path).alias(name) for path, name in mapping.items()])


def flat_name(path: str) -> str:
    return path.replace(".", "_")


def flatten_keys(df: DataFrame, keys: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Add one column per dotted key named with ``.`` -> ``_`` in a single projection."""
    keys = list(keys)
    return df.select(*[F.col(k) for k in keep], *[F.col(k).alias(flat_name(k)) for k in keys])
