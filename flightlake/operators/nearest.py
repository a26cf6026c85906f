"""Nearest weather point within a distance limit (J3 for places that are not on the grid).

The globe is cut into bands of latitude as high as the limit and each band into cells
at least as wide, fewer towards the poles.  A place then looks into the ring of cells
that its limit can reach: up to three bands with a handful of cells each, across the
antimeridian and over the poles.  This makes an equi-join on (band, cell); the
great-circle distance decides among what it finds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.geo import EARTH_RADIUS_KM, haversine_km
from flightlake.operators.broadcast import is_bounded

MAX_BROADCAST_POINTS = 500_000


def _height(max_km: float) -> float:
    """Degrees of latitude that the limit reaches (distances are rounded, so a little more)."""
    return min(math.degrees((max_km + 0.001) / EARTH_RADIUS_KM), 180.0)


def _band(lat: Column, height: float) -> Column:
    last = max(math.ceil(180.0 / height) - 1, 0)
    return F.greatest(F.least(F.floor((lat + 90.0) / F.lit(height)), F.lit(last)), F.lit(0))


def _cells(band: Column, height: float) -> Column:
    """Number of cells of a band: as wide as ``height`` where the band is nearest to the equator."""
    south, north = band * F.lit(height) - 90.0, (band + 1) * F.lit(height) - 90.0
    widest = F.when((south <= 0) & (north >= 0), F.lit(0.0)).otherwise(F.least(F.abs(south), F.abs(north)))
    return F.greatest(F.floor(F.lit(360.0) * F.cos(F.radians(widest)) / F.lit(height)), F.lit(1)).cast("long")


def _place(lon: Column, cells: Column) -> Column:
    """Cell of a longitude, not yet wrapped around the globe."""
    return F.floor((lon + 180.0) * cells / F.lit(360.0))


def nearest_point(points: DataFrame, stations: DataFrame, max_km: float, lat: str = "lat", lon: str = "lon",
                  station: str = "station", station_lat: str = "station_lat", station_lon: str = "station_lon",
                  max_broadcast_points: int = MAX_BROADCAST_POINTS) -> DataFrame:
    """``points`` with ``station`` and ``station_km`` of the nearest station not farther than ``max_km``.

    Null for places that have none, or no position; of equally near ones (to 0.1 m) the smallest station
    counts.  Places are looked up once each, however many points share them.  A table of at
    most ``max_broadcast_points`` stations is broadcast; a larger one is shuffled by cell.
    """
    height = _height(max_km)
    known = stations.select(F.col(station).alias("station"), F.col(station_lat).alias("_slat"), F.col(station_lon).alias("_slon"))
    known = known.where(F.abs("_slat").between(0.0, 90.0) & F.abs("_slon").between(0.0, 360.0))
    known = known.withColumn("_band", _band(F.col("_slat"), height))
    known = known.withColumn("_cell", F.pmod(_place(F.col("_slon"), _cells(F.col("_band"), height)), _cells(F.col("_band"), height)))
    places = points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    places = places.where(F.abs("_lat").between(0.0, 90.0) & F.abs("_lon").between(0.0, 360.0))
    rings = places.withColumn("_band", F.explode(F.sequence(_band(F.col("_lat") - height, height),
                                                            _band(F.col("_lat") + height, height))))
    # how far east and west the limit reaches: everywhere, if a pole is inside
    reach = F.when(F.abs("_lat") + height >= 90.0, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.sin(F.radians(F.lit(height))) / F.cos(F.radians("_lat")), F.lit(1.0)))) + 1e-9)
    cells = _cells(F.col("_band"), height)
    rings = rings.withColumns({"_n": cells, "_reach": reach})
    west, east = _place(F.col("_lon") - F.col("_reach"), F.col("_n")), _place(F.col("_lon") + F.col("_reach"), F.col("_n"))
    east = F.least(east, west + F.col("_n") - 1)  # once round the globe at most
    rings = (rings.withColumn("_turn", F.explode(F.sequence(west, east)))
             .withColumn("_cell", F.pmod("_turn", "_n")).select("_lat", "_lon", "_band", "_cell"))
    if is_bounded(known, max_broadcast_points):
        known = F.broadcast(known)
    met = (rings.join(known, ["_band", "_cell"])
           .withColumn("station_km", haversine_km("_lat", "_lon", "_slat", "_slon")).where(F.col("station_km") <= max_km))
    best = (met.groupBy("_lat", "_lon").agg(F.min(F.struct("station_km", "station")).alias("_best"))
            .select("_lat", "_lon", "_best.station", "_best.station_km"))
    return (points.join(best, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left").drop("_lat", "_lon"))
