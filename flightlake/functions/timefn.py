"""Epoch / calendar helpers.  The session time zone is pinned to UTC by
``flightlake.session``; display zones are explicit parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def iso_to_epoch(text) -> Column:
    """ISO-8601 text -> UTC epoch seconds; naive text is read as UTC; bad text -> null.

    Fractions of a second are truncated toward zero (as ``int(timestamp)``
    does), so a time just before 1970 gives 0, not -1.
    """
    micros = F.unix_micros(F.try_to_timestamp(_c(text)))
    return (micros / F.lit(1_000_000)).cast("long")


def epoch_to_date(epoch) -> Column:
    """Epoch seconds -> UTC calendar date."""
    return F.to_date(F.timestamp_seconds(_c(epoch)))


def epoch_to_text(epoch, tz: str = "UTC", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds -> wall-clock text in ``tz``."""
    ts = F.timestamp_seconds(_c(epoch))
    if tz != "UTC":
        ts = F.from_utc_timestamp(ts, tz)
    return F.date_format(ts, fmt)


def day_start(epoch) -> Column:
    """Epoch of 00:00 UTC of the epoch's day."""
    e = _c(epoch)
    return e - F.pmod(e, F.lit(SECONDS_PER_DAY))


def hour_offset(epoch, start) -> Column:
    """1-based hour index of ``epoch`` counted from ``start`` (truncating)."""
    return ((_c(epoch) - _c(start)) / F.lit(SECONDS_PER_HOUR)).cast("long") + F.lit(1)


def ordered_leg(a, b) -> tuple[Column, Column]:
    """(earlier, later) of two leg times; reversed legs are tolerated."""
    return F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b))


def trailing_start(start_epoch, past_days: int) -> Column:
    """First calendar date of the trailing history window ending on the start date."""
    return F.date_sub(epoch_to_date(start_epoch), past_days)
