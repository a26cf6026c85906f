"""Per-flight systematic sample of a position trail (W1) and latest fix.

Trail order is newest first: ``time`` descending, then ``payload_seq``
descending, then position ``pos`` ascending inside a payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixes are physically rate-limited (about one per second), so one flight-hour
# bounds the size of every window partition below, even for a flight holding
# a large share of all rows.
DEFAULT_BUCKET_SECONDS = 3600


def _order_cols():
    return [F.col("time").desc(), F.col("payload_seq").desc(), F.col("pos").asc()]


def trail_row_number(trail: DataFrame, key: str = "flight_id",
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``rn`` (0-based, newest first) per ``key`` without a whole-flight window.

    Two-level numbering: row numbers inside ``(key, time bucket)`` groups plus
    the number of fixes in all newer buckets of the same key (a window over the
    per-bucket counts, which are few per key).
    """
    bucketed = trail.withColumn("_bucket", F.floor(F.col("time") / F.lit(bucket_seconds)))
    counts = bucketed.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    newer_first = Window.partitionBy(key).orderBy(F.col("_bucket").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_bucket",
                            F.coalesce(F.sum("_cnt").over(newer_first), F.lit(0)).alias("_offset"))
    in_bucket = Window.partitionBy(key, "_bucket").orderBy(*_order_cols())
    return (bucketed.withColumn("_rn", F.row_number().over(in_bucket))
            .join(offsets, [key, "_bucket"], "inner")
            .withColumn("rn", F.col("_offset") + F.col("_rn") - F.lit(1))
            .drop("_bucket", "_rn", "_offset"))


def sample_every_nth(trail: DataFrame, every: int = 10, key: str = "flight_id",
                     bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Keep fixes 0, n, 2n, ... of each flight in newest-first order."""
    numbered = trail_row_number(trail, key, bucket_seconds)
    return numbered.filter(F.pmod(F.col("rn"), F.lit(every)) == 0)


def latest_fix(trail: DataFrame, key: str = "flight_id",
               fields=("lat", "lng", "alt", "spd", "time", "hd")) -> DataFrame:
    """Newest fix per flight (trail element 0), as a partial/final aggregate."""
    order = F.struct(F.col("time"), F.col("payload_seq"), (-F.col("pos")).alias("npos"))
    best = F.max_by(F.struct(*[F.col(f) for f in fields]), order)
    return trail.groupBy(key).agg(best.alias("_fix")).select(key, "_fix.*")
