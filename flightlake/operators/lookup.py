"""Airport lookups: exactly-one code resolution (J1), validity semi/anti joins
(J2) and the busy-airport restriction (J5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.broadcast import checked_broadcast, is_bounded


def unique_airports(airports: DataFrame, code: str = "iata", lat: str = "latitude",
                    lon: str = "longitude", name: str = "name", digits: int = 4) -> DataFrame:
    """Codes carried by exactly one airport, with coordinates rounded to ``digits``.

    Computed on the whole dimension: a code on two rows is ambiguous and resolves
    to nothing, and a null or NaN coordinate leaves the code unresolved.
    Output columns: ``code, name, lat, lon``.
    """
    grouped = (airports.filter(F.col(code).isNotNull())
               .groupBy(F.col(code).alias("code"))
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.min(name).alias("name"),
                    F.min(lat).alias("_lat"),
                    F.min(lon).alias("_lon"),
                    F.count(lat).alias("_nlat"),
                    F.count(lon).alias("_nlon")))
    return (grouped
            .filter((F.col("_n") == 1) & (F.col("_nlat") == 1) & (F.col("_nlon") == 1)
                    & ~F.isnan("_lat") & ~F.isnan("_lon"))
            .select("code", "name",
                    F.round("_lat", digits).alias("lat"),
                    F.round("_lon", digits).alias("lon")))


def resolve_airports(flights: DataFrame, unique: DataFrame, dep_code: str = "departure_iata",
                     arr_code: str = "arrival_iata", max_broadcast_rows: int | None = 2_000_000
                     ) -> DataFrame:
    """Inner lookup of both leg ends; adds ``departure_lat/lon`` and ``arrival_lat/lon``.

    Flights whose codes do not resolve (unknown, ambiguous, null) drop out, which
    is the set form of the sentinel filters.  The dimension is broadcast only
    after its row count is checked (once for both ends); a larger dimension is
    joined by shuffle.
    """
    small = is_bounded(unique, max_broadcast_rows)
    out = flights
    for prefix, code_col in (("departure", dep_code), ("arrival", arr_code)):
        side = unique.select(F.col("code").alias(f"_{prefix}_code"),
                             F.col("lat").alias(f"{prefix}_lat"),
                             F.col("lon").alias(f"{prefix}_lon"))
        side = F.broadcast(side) if small else side
        out = out.join(side, F.col(code_col) == F.col(f"_{prefix}_code"), "inner")
    return out.drop("_departure_code", "_arrival_code")


def _code_side(unique: DataFrame, max_rows: int | None) -> DataFrame:
    side = unique.select(F.col("code").alias("_valid_code"))
    return checked_broadcast(side, max_rows) if max_rows else side


def valid_code_semi(df: DataFrame, unique: DataFrame, code_col: str,
                    max_broadcast_rows: int | None = 2_000_000) -> DataFrame:
    """Rows whose code names exactly one airport (left semi join)."""
    return df.join(_code_side(unique, max_broadcast_rows),
                   F.col(code_col) == F.col("_valid_code"), "left_semi")


def invalid_code_anti(df: DataFrame, unique: DataFrame, code_col: str,
                      max_broadcast_rows: int | None = 2_000_000) -> DataFrame:
    """Rejects: rows whose code is unknown, ambiguous or null (left anti join)."""
    return df.join(_code_side(unique, max_broadcast_rows),
                   F.col(code_col) == F.col("_valid_code"), "left_anti")


def busy_airport_semi(df: DataFrame, busy: DataFrame, code_col: str,
                      busy_code: str = "iata", max_broadcast_rows: int = 100_000) -> DataFrame:
    """Restrict to the busy-airport allow list (left semi join).

    The list is small by nature (50 entries built in), but it may come from a
    user file, so it is broadcast only after its size is checked.
    """
    side = busy.select(F.col(busy_code).alias("_busy_code")).distinct()
    side = checked_broadcast(side, max_broadcast_rows)
    return df.join(side, F.col(code_col) == F.col("_busy_code"), "left_semi")
