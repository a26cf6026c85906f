"""Which pull a landed row belongs to, and the newest one.

A pull is one run of a download.  Its files lie in a folder ``pull=<name>`` (names
sort in time), or else each file is a pull of its own, named by the time it was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pull_name() -> Column:
    """Pull of a row that is read from files (batch or stream): a name that sorts in time.

    Names of folders sort after file times, whatever they are.
    """
    folder = F.regexp_extract("_metadata.file_path", "/pull=([^/]+)/", 1)
    written = F.date_format("_metadata.file_modification_time", "yyyyMMdd'T'HHmmss.SSSSSS")
    return F.when(folder != "", F.concat(F.lit("pull="), folder)).otherwise(
        F.concat(F.lit("file="), written, F.lit("/"), F.col("_metadata.file_name")))


def pull_number() -> Column:
    """Pull of a row that is read from files, as a number that grows: microseconds since 1970.

    From the folder ``pull=<name>`` where its name is a time (``yyyyMMddTHHmmss``, UTC, or
    seconds since 1970), so that copying files does not reorder pulls; else the time the file was written.
    """
    return F.coalesce(_folder_time("pull"), F.unix_micros("_metadata.file_modification_time"))


def issue_time() -> Column:
    """Seconds since 1970 at which a forecast was issued: its folder ``issue=<time>``, or else its pull."""
    return F.floor(F.coalesce(_folder_time("issue"), pull_number()) / F.lit(1_000_000))


def _folder_time(key: str) -> Column:
    name = F.regexp_extract("_metadata.file_path", f"/{key}=([^/]+)/", 1)
    seconds = F.when(name.rlike("^[0-9]{1,12}$"), name.cast("long"))
    stamp = F.unix_timestamp(F.when(name.rlike("^[0-9]{8}T[0-9]{6}$"), name), "yyyyMMdd'T'HHmmss")
    return F.coalesce(seconds, stamp) * F.lit(1_000_000)


def newest_nonempty(envelopes: DataFrame, data: str = "data", pull: str = "pull") -> DataFrame:
    """The envelopes of the newest pull that holds a record; an empty pull never replaces it.

    The newest name is one aggregate, then a filter with a literal.
    """
    newest = envelopes.where(F.size(data) > 0).agg(F.max(pull)).first()[0]
    return envelopes.where((F.col(pull) == F.lit(newest)) & (F.size(data) > 0))


def newest_pull(rows: DataFrame, key: str, pull: str = "pull") -> DataFrame:
    """The rows of each key's newest pull (an aggregate of two columns, joined back)."""
    newest = rows.groupBy(F.col(key).alias("_k")).agg(F.max(pull).alias("_newest"))
    return rows.join(newest, F.col(key).eqNullSafe(F.col("_k")) & (F.col(pull) == F.col("_newest"))).drop("_k", "_newest")
