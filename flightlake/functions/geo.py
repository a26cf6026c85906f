"""Geometry on lat/lon degrees: great-circle distance and timed straight-line paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
# Distance per path segment when the segment count follows the leg length (M4).
KM_PER_SEGMENT = 10.0
MAX_SEGMENTS = 30


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def round_half_even(x, digits: int) -> Column:
    """Round half to even on the scaled binary value (NumPy ``round`` semantics)."""
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM,
                 digits: int | None = 4) -> Column:
    """Great-circle distance in km (haversine, atan2 form), rounded to ``digits``."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    s_lat = F.sin(dlat / 2)
    s_lon = F.sin(dlon / 2)
    a = s_lat * s_lat + F.cos(p1) * F.cos(p2) * (s_lon * s_lon)
    a = F.least(a, F.lit(1.0))  # guard: rounding can push a above 1 for antipodes
    dist = F.lit(radius) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))
    return F.round(dist, digits) if digits is not None else dist


def segment_count(distance_km) -> Column:
    """Distance-driven segment count: floor(km / 10) clamped to [1, 30] (M4)."""
    n = F.floor(_c(distance_km) / F.lit(KM_PER_SEGMENT)).cast("int")
    return F.least(F.greatest(n, F.lit(1)), F.lit(MAX_SEGMENTS))


def _point_fields(lat0, lon0, lat1, lon1, t0, t1, i: Column, n: Column, digits: int
                  ) -> dict[str, Column]:
    """Coordinates and time of point ``i`` of an ``n``-segment straight-line path."""
    r_lat0, r_lon0 = F.radians(_c(lat0)), F.radians(_c(lon0))
    d_lat = F.radians(_c(lat1)) - r_lat0
    d_lon = F.radians(_c(lon1)) - r_lon0
    start = _c(t0).cast("double")
    span = (_c(t1) - _c(t0)).cast("double")
    step = F.lit(1.0) / n.cast("double")
    frac = F.when(i == n, F.lit(1.0)).otherwise(i.cast("double") * step)
    return {
        "idx": i.cast("int"),
        "lat": round_half_even(F.degrees(r_lat0 + frac * d_lat), digits),
        "lon": round_half_even(F.degrees(r_lon0 + frac * d_lon), digits),
        "t": (start + frac * span + F.lit(0.5)).cast("long"),
    }


def _segments(segments) -> Column:
    return segments if isinstance(segments, Column) else F.lit(int(segments))


def path_points(lat0, lon0, lat1, lon1, t0, t1, segments=3, digits: int = 5) -> Column:
    """Timed straight-line path (linear in degrees) as ``array<struct<idx,lat,lon,t>>``.

    ``segments + 1`` evenly spaced points at fractions ``i * (1/n)`` with the last
    fraction exactly 1, coordinates rounded half-even to ``digits`` and time
    ``trunc(t0 + f * (t1 - t0) + 0.5)``.  ``segments`` may be an int or a Column.
    Use ``explode_path`` when one row per point is wanted: it stays inside
    whole-stage code generation, which array lambdas do not.
    """
    n = _segments(segments)

    def point(i: Column) -> Column:
        fields = _point_fields(lat0, lon0, lat1, lon1, t0, t1, i, n, digits)
        return F.struct(*[c.alias(k) for k, c in fields.items()])

    return F.transform(F.sequence(F.lit(0), n.cast("int")), point)


def explode_path(df, lat0, lon0, lat1, lon1, t0, t1, segments=3, digits: int = 5,
                 keep=()):
    """One row per path point (``keep..., idx, lat, lon, t``): the rows of ``path_points``."""
    n = _segments(segments)
    base = df.select(*keep, _c(lat0).alias("_lat0"), _c(lon0).alias("_lon0"),
                     _c(lat1).alias("_lat1"), _c(lon1).alias("_lon1"),
                     _c(t0).alias("_t0"), _c(t1).alias("_t1"), n.cast("int").alias("_n"))
    rows = base.select("*", F.explode(F.sequence(F.lit(0), F.col("_n"))).alias("_i"))
    fields = _point_fields("_lat0", "_lon0", "_lat1", "_lon1", "_t0", "_t1",
                           F.col("_i"), F.col("_n"), digits)
    return rows.select(*keep, *[c.alias(k) for k, c in fields.items()])


def grid_cell(lat, lon, resolution_deg: float = 0.25) -> Column:
    """Row-major id of the ``resolution_deg`` grid cell holding (lat, lon).

    Longitudes wrap (180 is -180); latitude 90 belongs to the last row.
    """
    res = F.lit(float(resolution_deg))
    n_lon = int(round(360.0 / resolution_deg))
    n_lat = int(round(180.0 / resolution_deg))
    row = F.least(F.floor((_c(lat) + F.lit(90.0)) / res), F.lit(n_lat - 1))
    col = F.pmod(F.floor((_c(lon) + F.lit(180.0)) / res), F.lit(n_lon))
    return row * F.lit(n_lon) + col


def grid_columns(resolution_deg: float) -> int:
    """Number of cells in a row of the grid (what ``cell`` is divided by)."""
    return int(round(360.0 / resolution_deg))


def _spread_bits(x: Column) -> Column:
    """The low 16 bits of ``x`` with a zero between neighbours (65,536 columns: cells of 0.006 degrees)."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = F.shiftleft(x, shift).bitwiseOR(x).bitwiseAND(F.lit(mask))
    return x


def cell_place(cell, n_lon: int) -> Column:
    """Place of a ``grid_cell`` on the Morton curve: bits of its row and column in turns."""
    c = _c(cell).cast("long")
    return F.shiftleft(_spread_bits(F.floor(c / F.lit(n_lon))), 1).bitwiseOR(_spread_bits(F.pmod(c, F.lit(n_lon))))
