"""Size-checked broadcast: hint a join side only when its row count is bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension above this many rows is joined by shuffle (AQE may still pick a
# broadcast at run time from real sizes, within spark.sql.autoBroadcastJoinThreshold).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def is_bounded(df: DataFrame, max_rows: int | None) -> bool:
    """True when ``df`` provably has at most ``max_rows`` rows.

    A plain count: every task sends one number, no row meets another task.  (A
    limit before the count would move up to ``max_rows`` rows into one task.)
    """
    return bool(max_rows) and df.count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df
