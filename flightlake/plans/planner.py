"""Planner (Q1, Q2): risk-scored waypoints for every scheduled flight.

schedule -> whitespace clean-up -> status filters -> exactly-one airport
lookup -> epochs -> distance -> timed path -> waypoint rows -> weather risk
-> band.  All native expressions; shuffles only for the weather joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.geo import (explode_path, grid_cell, haversine_km, path_points,
                                      segment_count)
from flightlake.functions.risk import risk_band
from flightlake.functions.text import normalize_strings
from flightlake.functions.timefn import iso_to_epoch
from flightlake.operators.lookup import resolve_airports
from flightlake.operators.weather_risk import score_waypoints
from flightlake.schemas import SCORED_METRICS
from flightlake.session import materialize
from flightlake.sources.schedule import drop_null_status, scheduled_only

FLIGHT_KEY = "flight_iata"
# Names one leg; flight numbers repeat from day to day and may be null.
LEG_KEY = "leg_id"
# What the points of a leg are made of.
POINT_COLUMNS = ("departure_lat", "departure_lon", "arrival_lat", "arrival_lon", "departure_epoch", "arrival_epoch", "n_segments")
# Why a flight cannot be planned (``leg_rejects``), the first that holds.
REJECT_REASONS = ("departure_code", "arrival_code", "time")


def prepare_schedule(schedule: DataFrame, statuses: Sequence[str] | None = ("scheduled",),
                     normalize: bool = True) -> DataFrame:
    """Clean-up and status filters of the flat schedule."""
    df = normalize_strings(schedule) if normalize else schedule
    if statuses:
        df = scheduled_only(df, statuses)
    return drop_null_status(df)


def leg_metrics(schedule: DataFrame, unique_airports: DataFrame,
                segments: int | str = 3, max_flights: int | None = None) -> DataFrame:
    """Resolved legs with epochs, distance and the timed path.

    ``segments='by_distance'`` switches to the distance-driven count (M4).
    ``max_flights`` keeps the earliest departures (ordered, repeatable).
    Legs with an unparseable time are dropped (see ``leg_rejects``).
    """
    legs = resolve_airports(schedule, unique_airports)
    if not {"departure_epoch", "arrival_epoch"} <= set(legs.columns):
        # Landed tables (sources.landing) already carry the parsed epochs.
        legs = legs.withColumns({
            "departure_epoch": iso_to_epoch("departure_scheduled"),
            "arrival_epoch": iso_to_epoch("arrival_scheduled"),
        })
    legs = legs.filter(F.col("departure_epoch").isNotNull() & F.col("arrival_epoch").isNotNull())
    dist = haversine_km("departure_lat", "departure_lon", "arrival_lat", "arrival_lon")
    legs = legs.withColumn("airport_distance", dist)
    n = segment_count(F.col("airport_distance")) if segments == "by_distance" \
        else F.lit(int(segments))
    legs = legs.withColumn("n_segments", n.cast("int"))
    legs = legs.withColumn("flight_path", path_points(
        "departure_lat", "departure_lon", "arrival_lat", "arrival_lon",
        "departure_epoch", "arrival_epoch", F.col("n_segments")))
    if max_flights:
        legs = legs.orderBy("departure_epoch", FLIGHT_KEY).limit(max_flights)
    return legs


def identified(legs: DataFrame) -> DataFrame:
    """Legs with ``leg_id``, written once so that the id is the same wherever they are read.

    Date, number, codes, epochs and pull do not tell legs apart for certain (pages
    overlap, numbers are missing): the id is a row id of the written table.
    """
    return materialize(legs.withColumn(LEG_KEY, F.monotonically_increasing_id()), "legs")


def planner_table(legs: DataFrame, observed: DataFrame, forecast: DataFrame, **plan_options) -> DataFrame:
    """The planner's product: one row per leg with schedule columns, coordinates, epochs,
    distance, ``flight_path`` and its ``risk_path`` (S8, A6).

    ``legs`` come from ``identified``; ``plan_options`` go to ``plan_waypoints``.
    Legs are laid out by their id before their points are made, and stay so: where the
    risk table is broadcast, no waypoint is shuffled to put the paths together again.
    """
    placed = by_leg(legs)
    scored = plan_waypoints(placed, observed, forecast, keep=(LEG_KEY,), materialize_legs=False, **plan_options)
    paths = path_with_risk(scored).select(LEG_KEY, F.col("path").alias("risk_path"))
    return placed.drop("n_segments").join(paths, LEG_KEY, "left")


def by_leg(legs: DataFrame) -> DataFrame:
    """``identified`` legs laid out by id: one row a leg is shuffled here instead of its points later."""
    return legs.repartition(LEG_KEY)


def leg_rejects(schedule: DataFrame, unique_airports: DataFrame) -> DataFrame:
    """Flights that cannot be planned, with the reason (unresolved code or bad time)."""
    dep_ok = unique_airports.select(F.col("code").alias("_dc"))
    arr_ok = unique_airports.select(F.col("code").alias("_ac"))
    s = (schedule.join(dep_ok, F.col("departure_iata") == F.col("_dc"), "left")
         .join(arr_ok, F.col("arrival_iata") == F.col("_ac"), "left"))
    no_departure, no_arrival, no_time = map(F.lit, REJECT_REASONS)
    reason = (F.when(F.col("_dc").isNull(), no_departure)
              .when(F.col("_ac").isNull(), no_arrival)
              .when(iso_to_epoch("departure_scheduled").isNull()
                    | iso_to_epoch("arrival_scheduled").isNull(), no_time))
    return s.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull()) \
        .drop("_dc", "_ac")


def waypoints(legs: DataFrame, keep: Sequence[str] = (FLIGHT_KEY,)) -> DataFrame:
    """One row per path point: ``keep..., idx, lat, lon, t, leg_start``.

    Generated row-wise (explode of the index range + column expressions), the
    same points as the ``flight_path`` array but inside whole-stage codegen.
    """
    with_start = legs.withColumn("leg_start", F.least("departure_epoch", "arrival_epoch"))
    return explode_path(with_start, "departure_lat", "departure_lon", "arrival_lat",
                        "arrival_lon", "departure_epoch", "arrival_epoch",
                        F.col("n_segments"), keep=(*keep, "leg_start"))


def default_cell(lat: Column, lon: Column) -> Column:
    return grid_cell(lat, lon, 0.25)


def plan_waypoints(legs: DataFrame, observed: DataFrame, forecast: DataFrame,
                   cell_fn: Callable[[Column, Column], Column] = default_cell,
                   past_days: int = 90, hour_anchor: str = "leg_start",
                   metrics: Sequence[str] = SCORED_METRICS, nan_policy: str = "propagate",
                   keep: Sequence[str] = (FLIGHT_KEY,),
                   materialize_legs: bool = True, prune_weather: bool = True,
                   invert: Sequence[str] = (), as_of: int | None = None) -> DataFrame:
    """Risk-scored waypoints: ``keep..., idx, lat, lon, t, risk, band`` (Q1).

    With ``materialize_legs`` what the points are made of is written once to the shared
    checkpoint folder (``spark.checkpoint.dir``) before scoring: the schedule is not parsed
    twice, and a leg is one row where its points are four or more.
    ``invert`` names metrics where a lower value is riskier (e.g. visibility);
    by default every metric ranks upward, as in the original planner.  ``as_of`` is the
    time of the plan: of a forecast table with issues no later issue counts.
    """
    if materialize_legs:
        # The points feed both the distinct risk keys and the join back.
        legs = materialize(legs.select(*dict.fromkeys([*keep, *POINT_COLUMNS])), "legs-to-score")
    pts = waypoints(legs, keep).withColumn("cell", cell_fn(F.col("lat"), F.col("lon")))
    scored = score_waypoints(pts, observed, forecast, past_days, hour_anchor, metrics, nan_policy,
                             prune_weather, invert=invert, as_of=as_of)
    return scored.select(*keep, "idx", "lat", "lon", "t", "risk",
                         risk_band(F.col("risk")).alias("band"))


def path_with_risk(scored: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per leg, the ordered path with risk and band re-assembled.

    ``scored`` carries ``leg_id`` (see ``identified``), which names one leg, so an
    array holds at most 31 points.  ``keep`` are further columns of the leg.
    """
    keys = [LEG_KEY, *keep]
    pts = F.array_sort(F.collect_list(F.struct("idx", "lat", "lon", "t", "risk", "band")))
    return scored.groupBy(*keys).agg(pts.alias("path"))


def path_text(path: Column, field: str, sep: str = "|") -> Column:
    """Path field values as ``sep``-joined text (e.g. ``12.5|-1.0|97.2``)."""
    return F.array_join(F.transform(path, lambda p: p[field].cast("string")), sep)
