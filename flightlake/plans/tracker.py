"""Tracker (Q5): sampled trail, current position and projected path per flight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.geo import path_points
from flightlake.operators.sampling import latest_fix, sample_every_nth
from flightlake.session import materialize


def sampled_trail(trail: DataFrame, every: int = 10, written: bool = False) -> DataFrame:
    """Every ``every``-th fix of each flight, newest first.

    Row numbers and bucket counts both read the trail: it is written once, so a
    payload is parsed once (``written``: it comes from a table already).
    """
    return sample_every_nth(trail if written else materialize(trail, "trail"), every)


def current_position(trail: DataFrame) -> DataFrame:
    """Latest fix per flight."""
    return latest_fix(trail)


def future_path(latest: DataFrame, destinations: DataFrame, segments: int = 3) -> DataFrame:
    """Projected path from the latest fix to the destination (M3).

    ``destinations``: ``flight_id, dest_lat, dest_lon, scheduled_arrival``.
    Output: ``flight_id, idx, lat, lon, t``.
    """
    legs = latest.join(destinations, "flight_id", "inner")
    path = path_points("lat", "lng", "dest_lat", "dest_lon", "time", "scheduled_arrival", segments)
    return (legs.select("flight_id", F.explode(path).alias("_p"))
            .select("flight_id", "_p.idx", "_p.lat", "_p.lon", "_p.t"))
