"""Latest non-empty snapshot per source (S10, T2); newest complete pull of a paged source (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.broadcast import checked_broadcast
from flightlake.session import materialize


def latest_nonempty_snapshot(snapshots: DataFrame, source: str = "source",
                             ingest: str = "ingest_ts", data: str = "data",
                             tiebreak: str | None = None) -> DataFrame:
    """For each source, the newest snapshot whose ``data`` array is not empty.

    Empty payloads never replace the last good one.  ``tiebreak`` must tell snapshots of
    one time apart; without it one of them is taken.
    """
    good = snapshots.filter(F.size(F.col(data)) > 0)
    names = [ingest, *([tiebreak] if tiebreak else [])]
    # The newest (time, tie-break) of a source is found without its payload; the payload follows by a join.
    newest = good.groupBy(F.col(source).alias("_source")).agg(
        F.max(F.struct(*[F.col(c).alias(f"_{c}") for c in names])).alias("_newest")).select("_source", "_newest.*")
    same = F.col(source).eqNullSafe(F.col("_source"))
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = good.join(newest, same).select(source, *[c for c in snapshots.columns if c != source])
    return out if tiebreak else out.dropDuplicates([source])


def newest_complete_pull(pages: DataFrame, key: str, page: str = "page", pull: str = "pull", records: str = "records",
                         total: str | None = None) -> DataFrame:
    """The pages of each key's newest pull that is complete and holds a record, each page once.

    A pull is complete when it has every page: as many as ``total`` says (a column, null where unknown),
    and else all numbers from its first to its last one.  A pull with a missing page never replaces a
    complete one; a key that has no complete pull gives its newest pull with records.  ``records``
    is the number of records of a page.  Only numbers are aggregated; the pages follow by a join.
    """
    known = F.max(total) if total else F.lit(None).cast("long")
    pulls = (pages.groupBy(F.col(key).alias("_key"), F.col(pull).alias("_pull"))
             .agg(F.count_distinct(page).alias("_pages"), F.min(page).alias("_first"), F.max(page).alias("_last"),
                  F.sum(records).alias("_records"), known.alias("_total")).where(F.col("_records") > 0))
    whole = F.when(F.col("_total").isNotNull(), F.col("_pages") >= F.col("_total")).otherwise(
        F.col("_pages") == F.col("_last") - F.col("_first") + 1)
    newest = pulls.groupBy("_key").agg(F.max(F.struct(whole.alias("_whole"), "_pull"))["_pull"].alias("_pull"))
    # One row per key: where the keys are few, no page is moved to its key (one key's pages would be one task's).
    newest = checked_broadcast(materialize(newest, "newest-pulls"))
    return (pages.join(newest, F.col(key).eqNullSafe(F.col("_key")) & F.col(pull).eqNullSafe(F.col("_pull")))
            .drop("_key", "_pull").dropDuplicates([key, page]))
