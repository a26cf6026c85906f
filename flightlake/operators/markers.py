"""Airport markers for the planner map (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def airport_markers(legs: DataFrame) -> DataFrame:
    """One marker per (direction, airport name): its first known coordinates.

    Both directions come from one pass over the legs (each leg is tagged twice,
    then a single partial + final aggregate on ``(direction, airport)``).
    "First" is the smallest (flight number with nulls last, both epochs, both codes,
    coordinates) with a non-null latitude, so a marker has coordinates whenever a
    leg has; null names are dropped.  Unordered: see ``sorted_markers``.
    """
    ends = F.array(*[
        F.struct(F.lit(d).alias("direction"), F.col(f"{d}_airport").alias("airport"),
                 F.col(f"{d}_lat").alias("lat"), F.col(f"{d}_lon").alias("lon"))
        for d in ("departure", "arrival")])
    order = F.struct(F.col("flight_iata").isNull().alias("no_number"), F.coalesce("flight_iata", F.lit("")).alias("number"),
                     *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("departure_epoch", "arrival_epoch")],
                     *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("departure_iata", "arrival_iata")])
    tagged = legs.select(order.alias("_o"), F.inline(ends))
    return (tagged.filter(F.col("airport").isNotNull() & F.col("lat").isNotNull())
            .groupBy("direction", "airport")
            .agg(F.min(F.struct("_o", "lat", "lon")).alias("_p"))
            .select("direction", "airport", "_p.lat", "_p.lon"))


def sorted_markers(legs: DataFrame) -> DataFrame:
    """Markers in the order they are shown (L2): departures first, then by airport name."""
    return airport_markers(legs).orderBy(F.col("direction").desc(), "airport")
