"""Planner output written as CSV (paths as JSON text) and parquet, then re-read."""

from flightlake import catalog
from flightlake.plans import planner
from flightlake.sources.sinks import read_plan, write_plan
from tests.conftest import SF_SMALL


def test_plan_roundtrip(spark, tmp_path):
    legs = catalog._planned_legs(spark, SF_SMALL).select(
        "flight_iata", "departure_epoch", "arrival_epoch", "airport_distance", "flight_path")
    want = sorted(map(tuple, legs.collect()), key=lambda r: r[0])
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        write_plan(legs, path, fmt=fmt)
        back = read_plan(spark, path, legs.schema, fmt=fmt)
        got = sorted(map(tuple, back.collect()), key=lambda r: r[0])
        assert got == want, fmt


def test_path_with_risk_is_ordered(spark):
    scored = catalog._scored_legs(spark, SF_SMALL, ())
    p = planner.path_with_risk(scored).first()["path"]
    assert [x["idx"] for x in p] == [0, 1, 2, 3]


def test_planning_from_landed_parquet_equals_direct_plan(spark, tmp_path):
    """Payload JSON files -> landing -> planner gives the flagship's waypoints."""
    from flightlake.sources import fixtures as fx
    from flightlake.sources.landing import land_schedule

    json_dir, lake = str(tmp_path / "landing"), str(tmp_path / "schedule")
    fx.schedule_payloads(spark, SF_SMALL).write.text(json_dir)  # one envelope per line
    land_schedule(spark, json_dir, lake, multiline=False)
    landed = planner.prepare_schedule(spark.read.parquet(lake), normalize=False)
    w = fx.weather_v(spark, SF_SMALL)
    from_lake = planner.plan_waypoints(
        planner.leg_metrics(landed, catalog._unique(spark, SF_SMALL)), w, w,
        cell_fn=fx.fixture_cell)
    direct = catalog.planner_flagship(spark, SF_SMALL)
    assert sorted(map(repr, from_lake.collect())) == sorted(map(repr, direct.collect()))
