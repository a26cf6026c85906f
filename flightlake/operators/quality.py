"""Quality filter with a loss report (F5, A5), computed in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bad(df: DataFrame, column: str, sentinel: str | None):
    c = F.col(column)
    bad = c.isNull()
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        bad = bad | F.isnan(c)
    elif sentinel is not None and isinstance(dtype, T.StringType):
        bad = bad | (c == F.lit(sentinel))
    return bad


def quality_filter(df: DataFrame, column: str, sentinel: str | None = "NaN") -> DataFrame:
    """Drop rows whose ``column`` is null, NaN or the text sentinel."""
    return df.filter(~_bad(df, column, sentinel))


def quality_report(df: DataFrame, column: str, sentinel: str | None = "NaN") -> DataFrame:
    """Before/after counts, difference and percent loss for ``quality_filter``.

    One aggregate over the input; the percentage is null for an empty input.
    """
    bad = _bad(df, column, sentinel)
    counts = df.agg(F.count(F.lit(1)).alias("before"), F.count_if(~bad).alias("after"))
    diff = F.col("before") - F.col("after")
    pct = F.when(F.col("before") > 0,
                 F.round(diff.cast("double") * F.lit(100.0) / F.col("before").cast("double"), 6))
    return counts.select(F.lit(column).alias("column_name"), "before", "after",
                         diff.alias("difference"), pct.alias("pct_loss"))
