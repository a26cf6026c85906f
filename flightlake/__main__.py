"""Command line for the jobs: ``python -m flightlake <job> ...`` or, on a
cluster, ``spark-submit --py-files flightlake.zip flightlake/__main__.py <job> ...``.

plan     schedule envelopes (or a landed parquet table) + airports + weather
         -> planner table, risk-scored waypoints, markers, rejects and loss counts as parquet
board    board payloads + airports -> arrivals table and flight picker
track    flight-detail payloads -> sampled trail, current position, projected path
refresh  start the planner refresh stream over a landing folder (availableNow)
land     convert landed schedule / weather / forecast JSON into partitioned, versioned parquet
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from flightlake.functions.text import normalize_strings
from flightlake.operators.losses import Losses
from flightlake.operators.lookup import unique_airports
from flightlake.operators.markers import sorted_markers
from flightlake.plans import planner
from flightlake.plans.board import arrivals_table, flight_picker
from flightlake.plans.tracker import current_position, future_path, sampled_trail
from flightlake.session import build_session, materialize, run_folder
from flightlake.sources.airports import read_airports
from flightlake.sources.board import board_rows, newest_board, read_board
from flightlake.sources.detail import detail_flat, read_flight_detail, trail_rows
from flightlake.sources.landing import land_forecast, land_schedule, land_weather
from flightlake.sources.pulls import newest_nonempty, newest_pull, pull_name
from flightlake.sources.schedule import explode_records, flat_schedule, read_schedule_envelopes
from flightlake.sources.sinks import write_plan
from flightlake.sources.versions import is_versioned, read_version


def _weather(spark, path):
    """A landed (versioned) weather table at its newest version, or plain parquet."""
    return read_version(spark, path) if is_versioned(spark, path) else spark.read.parquet(path)


def cmd_plan(spark, a):
    losses = Losses()
    status = F.col("flight_status")
    if a.schedule_format == "parquet":
        landed = spark.read.parquet(a.schedule)
        # every pull on disk holds records: the newest one is planned
        newest = landed.agg(F.max(F.col("pull").cast("string"))).first()[0]
        flat = landed.where(F.col("pull") == newest)
    else:
        files = losses.watch(read_schedule_envelopes(spark, a.schedule, multiline=not a.json_lines), "files",
                             read=F.count("*"), broken=F.count("broken"), empty=F.count_if(F.size("data") == 0))
        flat = normalize_strings(flat_schedule(explode_records(newest_nonempty(files))))
    flat = losses.watch(flat, "records", read=F.count("*"), no_status=F.count_if(status.isNull()),
                        other_status=F.count_if(status != "scheduled"))
    uniq = unique_airports(read_airports(spark, a.airports))
    # parsed once for legs, markers and rejects
    schedule = materialize(planner.prepare_schedule(flat, normalize=False), "schedule")
    legs = planner.leg_metrics(schedule, uniq,
                               segments="by_distance" if a.by_distance else 3,
                               max_flights=a.max_flights)
    legs = planner.identified(losses.watch(legs, "planned", legs=F.count("*")))
    table = planner.planner_table(legs, _weather(spark, a.weather), _weather(spark, a.forecast), past_days=a.past_days,
                                  hour_anchor=a.hour_anchor, as_of=a.as_of)
    write_plan(table, f"{a.out}/plan", fmt=a.format)
    if a.format == "parquet":
        points = spark.read.parquet(f"{a.out}/plan")
    else:
        points = materialize(table, "plan")
    keep = ["leg_id", "flight_date", "flight_iata", "departure_epoch", "arrival_epoch"]
    write_plan(points.select(*keep, F.inline("risk_path")), f"{a.out}/waypoints", fmt=a.format)
    write_plan(sorted_markers(legs), f"{a.out}/markers", fmt=a.format)
    why = F.col("reject_reason")
    rejects = losses.watch(planner.leg_rejects(schedule, uniq), "rejected",
                           **{r: F.count_if(why == r) for r in planner.REJECT_REASONS})
    write_plan(rejects, f"{a.out}/rejects", fmt=a.format)
    # read = no_status + other_status + rejected + planned (and what --max-flights leaves out)
    write_plan(losses.table(spark), f"{a.out}/losses", fmt=a.format)


def cmd_board(spark, a):
    rows = board_rows(newest_board(read_board(spark, a.boards, multiline=not a.json_lines)))
    uniq = unique_airports(read_airports(spark, a.airports))
    arrivals = materialize(arrivals_table(rows, tz=a.tz, valid_airports=uniq), "arrivals")
    write_plan(arrivals, f"{a.out}/arrivals", fmt=a.format)
    write_plan(flight_picker(arrivals), f"{a.out}/picker", fmt=a.format)


def cmd_track(spark, a):
    details = read_flight_detail(spark, a.details, multiline=not a.json_lines).withColumn("pull", pull_name())
    # parsed once; of a flight that was pulled several times the newest pull counts
    details = materialize(newest_pull(details.withColumn("_flight", F.col("identification.id")), "_flight").drop("_flight"),
                          "details")
    trail = materialize(trail_rows(details), "trail")
    write_plan(sampled_trail(trail, a.every, written=True), f"{a.out}/trail", fmt=a.format)
    latest = current_position(trail)
    write_plan(latest, f"{a.out}/position", fmt=a.format)
    dest = detail_flat(details).select(
        F.col("id").alias("flight_id"), F.col("destination_airport_lat").alias("dest_lat"),
        F.col("destination_airport_lon").alias("dest_lon"),
        F.col("scheduled_arrival_time").alias("scheduled_arrival")).dropDuplicates(["flight_id"])
    write_plan(future_path(latest, dest), f"{a.out}/future_path", fmt=a.format)


def cmd_refresh(spark, a):
    from flightlake.streaming.refresh import start_refresh
    uniq = unique_airports(read_airports(spark, a.airports))
    # versioned tables go as paths: every batch takes their newest version
    weather, forecast = (p if is_versioned(spark, p) else spark.read.parquet(p) for p in (a.weather, a.forecast))
    q = start_refresh(spark, a.landing, a.out, a.checkpoint, uniq, weather, forecast, past_days=a.past_days)
    q.awaitTermination()


def cmd_land(spark, a):
    if a.schedule:
        land_schedule(spark, a.schedule, f"{a.out}/schedule")
    if a.weather:
        land_weather(spark, a.weather, f"{a.out}/weather", resolution_deg=a.resolution)
    if a.forecast:
        land_forecast(spark, a.forecast, f"{a.out}/forecast", resolution_deg=a.resolution)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="flightlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("plan")
    s.add_argument("--schedule", required=True)
    s.add_argument("--schedule-format", choices=["json", "parquet"], default="json")
    s.add_argument("--airports", required=True)
    s.add_argument("--weather", required=True, help="landed table of observed weather")
    s.add_argument("--forecast", required=True, help="landed table of forecasts")
    s.add_argument("--as-of", type=int, help="seconds since 1970: later issues of a forecast do not count")
    s.add_argument("--past-days", type=int, default=90)
    s.add_argument("--hour-anchor", choices=["leg_start", "utc"], default="leg_start")
    s.add_argument("--by-distance", action="store_true")
    s.add_argument("--max-flights", type=int)
    s.set_defaults(fn=cmd_plan)

    s = sub.add_parser("board")
    s.add_argument("--boards", required=True)
    s.add_argument("--airports", required=True)
    s.add_argument("--tz", default="UTC")
    s.set_defaults(fn=cmd_board)

    s = sub.add_parser("track")
    s.add_argument("--details", required=True)
    s.add_argument("--every", type=int, default=10)
    s.set_defaults(fn=cmd_track)

    s = sub.add_parser("refresh")
    s.add_argument("--landing", required=True)
    s.add_argument("--airports", required=True)
    s.add_argument("--weather", required=True)
    s.add_argument("--forecast", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--past-days", type=int, default=90)
    s.set_defaults(fn=cmd_refresh)

    s = sub.add_parser("land")
    s.add_argument("--schedule")
    s.add_argument("--weather", help="folder of observed weather responses")
    s.add_argument("--forecast", help="folder of forecast responses (issue=<time>/...)")
    s.add_argument("--resolution", type=float, default=0.25)
    s.set_defaults(fn=cmd_land)

    for name in ("plan", "board", "track", "refresh", "land"):
        sp = sub.choices[name]
        sp.add_argument("--out", required=True)
        if name in ("plan", "board", "track"):
            sp.add_argument("--format", choices=["parquet", "csv"], default="parquet")
            sp.add_argument("--json-lines", action="store_true",
                            help="payload files hold one JSON document per line "
                                 "(default: one document per file)")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")

    a = p.parse_args(argv)
    spark = build_session("flightlake-" + a.cmd, master=a.master)
    with run_folder(spark):
        a.fn(spark, a)


if __name__ == "__main__":
    main()
