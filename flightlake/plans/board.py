"""Airport board (Q3) and flight picker (Q4) for many airports in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.text import legacy_board_times, legacy_origin_name
from flightlake.functions.timefn import epoch_to_text
from flightlake.operators.dedup import last_wins
from flightlake.operators.lookup import valid_code_semi


def arrivals_table(rows: DataFrame, tz: str = "UTC",
                   valid_airports: DataFrame | None = None) -> DataFrame:
    """Arrivals with an id, as display columns.

    Input: ``board_rows`` output.  With ``valid_airports`` (``unique_airports``
    output) only boards of codes naming exactly one airport are kept, as the
    board of an invalid code is empty.  Output: ``airport_code, page, idx,
    flight_id, flight_number, airline, origin, departure_time, arrival_time``.
    """
    if valid_airports is not None:
        rows = valid_code_semi(rows, valid_airports, "airport_code")
    fid = F.col("flight_identification_id")
    return (rows.filter((F.col("Flight_type") != "departures") & fid.isNotNull() & (fid != ""))
            .select("airport_code", "page", "idx",
                    fid.alias("flight_id"),
                    F.col("flight_identification_callsign").alias("flight_number"),
                    F.col("flight_airline_name").alias("airline"),
                    F.col("flight_airport_origin.name").alias("origin"),
                    epoch_to_text(F.col("flight_time_scheduled.departure"), tz).alias("departure_time"),
                    epoch_to_text(F.col("flight_time_scheduled.arrival"), tz).alias("arrival_time")))


def legacy_arrivals_table(rows: DataFrame, origin_text: str, times_text: str,
                          tz: str = "UTC") -> DataFrame:
    """Arrivals table for boards whose sub-records arrive as ``{k=v, ...}`` text."""
    arr, dep = legacy_board_times(F.col(times_text))
    return rows.select("*", legacy_origin_name(F.col(origin_text)).alias("origin"),
                       epoch_to_text(dep, tz).alias("departure_time"),
                       epoch_to_text(arr, tz).alias("arrival_time"))


def flight_picker(arrivals: DataFrame) -> DataFrame:
    """Per airport and flight number: the last flight id in board order (A4).

    ``first_page``/``first_idx`` give the option order (first appearance).
    """
    order = F.struct(F.col("page"), F.col("idx"))
    picked = last_wins(arrivals, ["airport_code", "flight_number"], "flight_id", order)
    return picked.select("airport_code", "flight_number", "flight_id",
                         F.col("first_seen.page").alias("first_page"),
                         F.col("first_seen.idx").alias("first_idx"))
