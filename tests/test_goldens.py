"""Hand-made payload files (schedule, airports, board, detail, weather) -> expected rows."""

import json
import math

import pytest

from flightlake.functions.text import normalize_strings
from flightlake.operators.lookup import invalid_code_anti, unique_airports
from flightlake.plans import planner
from flightlake.plans.board import arrivals_table, flight_picker, legacy_arrivals_table
from flightlake.plans.tracker import current_position, future_path, sampled_trail
from flightlake.sources.airports import busy_airports, read_airports
from flightlake.sources.board import board_rows, read_board
from flightlake.sources.detail import detail_flat, read_flight_detail, trail_rows
from flightlake.sources.schedule import flat_schedule, read_schedule
from flightlake.sources.weather import read_weather, unpivot_hours

AIRPORTS_DAT = "\n".join([
    '1,"Alpha Airport","Town, North","Land","AAA","AAAA",10.123456,20.5,100,"1","E","Etc/UTC","airport","OurAirports"',
    '2,"Beta \\"B\\" Field","B","Land","BBB","BBBB",-5.0,30.0,50,"1","E","Etc/UTC","airport","OurAirports"',
    '3,"Dup One","X","Land","DUP","DUP1",1.0,1.0,0,"1","E","Etc/UTC","airport","OurAirports"',
    '4,"Dup Two","X","Land","DUP","DUP2",2.0,2.0,0,"1","E","Etc/UTC","airport","OurAirports"',
    '5,"No Code A","X","Land",\\N,"NC1",3.0,3.0,0,"1","E","Etc/UTC","airport","OurAirports"',
    '6,"No Code B","X","Land",\\N,"NC2",4.0,4.0,0,"1","E","Etc/UTC","airport","OurAirports"',
    '7,"Nan Code","X","Land","NAN","NANN",5.0,5.0,0,"1","E","Etc/UTC","airport","OurAirports"',
    '8,"Null Lat","X","Land","NUL","NULL",\\N,6.0,0,"1","E","Etc/UTC","airport","OurAirports"',
]) + "\n"


def _rec(status, dep, arr, dep_t, arr_t, airport="Alpha", codeshared=None, iata="X1"):
    return {"flight_date": "2024-03-01", "flight_status": status,
            "departure": {"airport": airport, "iata": dep, "scheduled": dep_t},
            "arrival": {"airport": "Beta", "iata": arr, "scheduled": arr_t},
            "airline": {"name": "Air  One", "iata": "A1", "icao": "AO1"},
            "flight": {"number": "1", "iata": iata, "icao": "X1", "codeshared": codeshared},
            "aircraft": None, "live": None}


SCHEDULE = {"pagination": {"limit": 100, "offset": 0, "count": 9, "total": 9}, "data": [
    _rec("scheduled", "AAA", "BBB", "2024-03-01T10:00:00+00:00", "2024-03-01T13:00:00+05:30",
         airport="  Alpha\t\tIntl  ", iata="R1"),
    _rec(None, "AAA", "BBB", "2024-03-01T10:00:00", "2024-03-01T12:00:00", iata="R2"),
    _rec("landed", "AAA", "BBB", "2024-03-01T10:00:00", "2024-03-01T12:00:00", iata="R3"),
    _rec("scheduled", "ZZZ", "BBB", "2024-03-01T10:00:00", "2024-03-01T12:00:00", iata="R4"),
    _rec("scheduled", "DUP", "BBB", "2024-03-01T10:00:00", "2024-03-01T12:00:00", iata="R5"),
    _rec("scheduled", None, "BBB", "2024-03-01T10:00:00", "2024-03-01T12:00:00", iata="R6"),
    _rec("scheduled", "AAA", "BBB", "not-a-time", "2024-03-01T12:00:00", iata="R7"),
    _rec("scheduled", "AAA", "NAN", "2024-03-01T10:00:00", "2024-03-01T12:00:00",
         codeshared={"airline_name": "x"}, iata="R8"),
    _rec("scheduled", "BBB", "AAA", "2024-03-01 10:00:00", "2024-03-01 12:30:00", iata="R9"),
]}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("payloads")
    (d / "airports.dat").write_text(AIRPORTS_DAT)
    (d / "schedule").mkdir()
    (d / "schedule" / "p1.json").write_text(json.dumps(SCHEDULE))
    (d / "schedule" / "empty.json").write_text(json.dumps({"pagination": {}, "data": []}))
    return d


def test_airports_csv(spark, files):
    a = read_airports(spark, str(files / "airports.dat"))
    assert "type" not in a.columns and "source" not in a.columns
    rows = {r["airport_id"]: r for r in a.collect()}
    assert rows[1]["city"] == "Town, North"
    assert rows[2]["name"] == 'Beta "B" Field'
    assert rows[5]["iata"] is None and rows[7]["iata"] == "NAN"
    assert rows[8]["latitude"] is None
    u = {r["code"]: (r["lat"], r["lon"]) for r in unique_airports(a).collect()}
    # exactly-one rule: DUP ambiguous, \N is null, NUL has no latitude
    assert set(u) == {"AAA", "BBB", "NAN"}
    assert u["AAA"] == (10.1235, 20.5)


def test_schedule_reader_and_planner_filters(spark, files):
    recs = read_schedule(spark, str(files / "schedule"))
    assert recs.count() == 9  # the empty envelope adds no rows
    flat = flat_schedule(recs)
    assert len(flat.columns) == 18
    by = {r["flight_iata"]: r for r in flat.collect()}
    assert json.loads(recs.filter("flight.iata = 'R8'").first()["flight"]["codeshared"]) == \
        {"airline_name": "x"}
    clean = normalize_strings(flat)
    assert clean.filter("flight_iata = 'R1'").first()["departure_airport"] == "Alpha Intl"
    assert clean.filter("flight_iata = 'R1'").first()["airline_name"] == "Air One"
    assert by["R1"]["departure_airport"] == "  Alpha\t\tIntl  "

    uniq = unique_airports(read_airports(spark, str(files / "airports.dat")))
    legs = planner.leg_metrics(planner.prepare_schedule(flat), uniq)
    got = {r["flight_iata"]: r for r in legs.collect()}
    # R2 null status, R3 landed, R4 unknown, R5 ambiguous, R6 null code, R7 bad time
    assert set(got) == {"R1", "R8", "R9"}
    r1 = got["R1"]
    assert r1["departure_epoch"] == 1709287200          # 10:00 UTC
    assert r1["arrival_epoch"] == 1709278200            # 13:00 +05:30 = 07:30 UTC (reversed)
    assert got["R9"]["departure_epoch"] == 1709287200   # naive text is UTC
    rej = {r["flight_iata"]: r["reject_reason"] for r in planner.leg_rejects(flat, uniq).collect()}
    assert rej == {"R4": "departure_code", "R5": "departure_code", "R6": "departure_code",
                   "R7": "time"}
    anti = {r["flight_iata"] for r in invalid_code_anti(flat, uniq, "departure_iata").collect()}
    assert anti == {"R4", "R5", "R6"}
    # reversed leg: path runs backwards in time, endpoints are the airports
    pts = sorted(r1["flight_path"], key=lambda p: p["idx"])
    assert (pts[0]["lat"], pts[0]["lon"], pts[0]["t"]) == (10.1235, 20.5, 1709287200)
    assert (pts[-1]["lat"], pts[-1]["lon"], pts[-1]["t"]) == (-5.0, 30.0, 1709278200)
    assert len(pts) == 4


BOARD = {"airport": {"code": "AAA", "page": 0, "pluginData": {"schedule": {
    "arrivals": {"data": [
        {"flight": {"identification": {"id": None, "callsign": "CS0"},
                    "airline": {"name": "Air"}, "airport": {"origin": {"name": "Zero"}},
                    "time": {"scheduled": {"departure": 1709280000, "arrival": 1709290000}}}},
        {"flight": {"identification": {"id": "a1", "callsign": "CS1"},
                    "airline": {"name": "Air"}, "airport": {"origin": {"name": "Foo, Bar"}},
                    "time": {"scheduled": {"departure": 1709280000, "arrival": 1709290000}}}},
        {"flight": {"identification": {"id": "a2", "callsign": "CS1"},
                    "airline": {"name": "Air"}, "airport": {"origin": None},
                    "time": {"scheduled": {"departure": 1709281000, "arrival": 1709291000}}}},
        {"flight": {"identification": {"id": "a3", "callsign": "CS2"},
                    "airline": {"name": "Air"}, "airport": {"origin": {"name": "Qux"}},
                    "time": {"scheduled": {"departure": 1709282000, "arrival": 1709292000}}}},
    ]},
    "departures": {"data": [
        {"flight": {"identification": {"id": "d1", "callsign": "CS9"},
                    "airline": {"name": "Air"}, "airport": {"origin": {"name": "Home"}},
                    "time": {"scheduled": {"departure": 1709280000, "arrival": 1709290000}}}},
    ]}}}}}


def test_board_union_arrivals_and_picker(spark, tmp_path):
    p = tmp_path / "board.json"
    p.write_text(json.dumps(BOARD))
    rows = board_rows(read_board(spark, str(p)))
    assert rows.count() == 5
    assert [r["Flight_type"] for r in rows.orderBy("Flight_type", "idx").collect()].count(
        "departures") == 1
    arr = arrivals_table(rows)
    got = {r["flight_id"]: r for r in arr.collect()}
    assert set(got) == {"a1", "a2", "a3"}  # null id and the departure are skipped
    assert got["a1"]["origin"] == "Foo, Bar"  # full name, no cut at the comma
    assert got["a2"]["origin"] is None
    assert got["a1"]["departure_time"] == "2024-03-01 08:00:00"
    picker = {r["flight_number"]: (r["flight_id"], r["first_idx"])
              for r in flight_picker(arr).collect()}
    assert picker == {"CS1": ("a2", 1), "CS2": ("a3", 3)}


def test_legacy_board_text(spark):
    df = spark.createDataFrame(
        [("{name=Foo Airport, code={iata=FOO}}", "{arrival=1709290000, departure=1709280000}"),
         ("{name=Bar, x=1}", "{departure=1709280000, arrival=1709290000}")],
        "o string, t string")
    got = legacy_arrivals_table(df, "o", "t").collect()
    assert got[0]["origin"] == "Foo Airport"
    assert got[0]["arrival_time"] == "2024-03-01 10:46:40"
    assert got[0]["departure_time"] == "2024-03-01 08:00:00"
    # departure listed first: the legacy spans read the departure for both
    assert got[1]["arrival_time"] == got[1]["departure_time"] == "2024-03-01 08:00:00"


def _detail(fid, n_fixes, dest=True, tie=False):
    t0 = 1709280000
    trail = [{"lat": 10.0 + i, "lng": 20.0 - i, "alt": 1000 * i, "spd": 400, "hd": 90,
              "ts": t0 - 60 * i} for i in range(n_fixes)]
    if tie and n_fixes > 1:
        trail[1]["ts"] = trail[0]["ts"]
    d = {"identification": {"id": fid, "callsign": "C" + fid},
         "aircraft": {"model": {"text": "A320", "code": "A20N"}},
         "airline": {"name": "Air"},
         "airport": {"origin": {"name": "Alpha", "code": {"iata": "AAA"},
                                "position": {"latitude": 10.0, "longitude": 20.0, "altitude": 5,
                                             "country": {"name": "Land"}}},
                     "destination": ({"name": "Beta", "code": {"iata": "BBB"},
                                      "position": {"latitude": -5.0, "longitude": 30.0,
                                                   "altitude": 7, "country": {"name": "Land"}}}
                                     if dest else None)},
         "time": {"scheduled": {"departure": t0 - 7200, "arrival": t0 + 3600},
                  "real": {"departure": t0 - 7000}, "estimated": {"arrival": t0 + 3500},
                  "historical": {"flighttime": "10800", "delay": "120"}},
         "trail": trail}
    return d


def test_detail_trail_sampling_and_projection(spark, tmp_path):
    p = tmp_path / "detail.json"
    docs = [_detail("f0", 0), _detail("f1", 1), _detail("f10", 10), _detail("f11", 11),
            _detail("f25", 25, dest=False, tie=True)]
    p.write_text("\n".join(json.dumps(d) for d in docs))
    details = read_flight_detail(spark, str(p), multiline=False)
    flat = {r["id"]: r for r in detail_flat(details).collect()}
    assert len(flat) == 5 and len(next(iter(flat.values()))) == 25
    assert flat["f25"]["destination_airport_lat"] is None
    assert flat["f1"]["destination_airport_lat"] == -5.0
    trail = trail_rows(details)
    assert trail.count() == 47
    sampled = sampled_trail(trail, 10)
    counts = {r["flight_id"]: r["count"] for r in sampled.groupBy("flight_id").count().collect()}
    assert counts == {"f1": 1, "f10": 1, "f11": 2, "f25": 3}  # ceil(n / 10)
    f25 = sorted((r["rn"], r["pos"]) for r in sampled.filter("flight_id = 'f25'").collect())
    assert f25 == [(0, 0), (10, 10), (20, 20)]  # tied ts keeps payload order
    latest = {r["flight_id"]: r for r in current_position(trail).collect()}
    assert latest["f25"]["lat"] == 10.0 and latest["f11"]["time"] == 1709280000
    dest = flat_to_dest(spark, flat)
    fp = future_path(current_position(trail), dest).filter("flight_id = 'f11'").orderBy("idx")
    pts = [(r["lat"], r["lon"], r["t"]) for r in fp.collect()]
    assert pts[0] == (10.0, 20.0, 1709280000) and pts[-1] == (-5.0, 30.0, 1709283600)


def flat_to_dest(spark, flat):
    rows = [(k, v["destination_airport_lat"], v["destination_airport_lon"],
             v["scheduled_arrival_time"]) for k, v in flat.items()
            if v["destination_airport_lat"] is not None]
    return spark.createDataFrame(rows, "flight_id string, dest_lat double, dest_lon double, "
                                       "scheduled_arrival long")


def test_weather_payload_unpivot(spark, tmp_path):
    p = tmp_path / "weather.json"
    hourly = {"time": [1709251200 + 3600 * i for i in range(3)]}
    for j, m in enumerate(["cloud_cover", "cloud_cover_high", "precipitation", "snow_depth",
                           "visibility", "weather_code", "lifted_index"]):
        hourly[m] = [float(10 * j + i) for i in range(3)]
    p.write_text(json.dumps({"latitude": 10.1, "longitude": 20.2, "hourly": hourly}))
    rows = read_weather(spark, str(p)).orderBy("ts_hour").collect()
    assert [r["precipitation"] for r in rows] == [20.0, 21.0, 22.0]
    assert rows[1]["ts_hour"] == 1709254800
    assert rows[0]["cell"] == (math.floor((10.1 + 90) / 0.25)) * 1440 + math.floor((20.2 + 180) / 0.25)


def _risk(spark, history, score, nan_policy="propagate", invert=()):
    day0 = 1709251200
    obs = spark.createDataFrame([(1, day0 - 3600 * i, v, 0.0, 0.0) for i, v in enumerate(history)],
                                "cell long, ts_hour long, precipitation double, "
                                "visibility double, snow_depth double")
    fc = spark.createDataFrame([(1, day0 + 7200, score, None, None)],
                               "cell long, ts_hour long, precipitation double, "
                               "visibility double, snow_depth double")
    keys = spark.createDataFrame([(1, day0, day0 + 7200)], "cell long, day0 long, fts long")
    from flightlake.operators.weather_risk import forecast_lookup, percentile_scores, \
        trailing_history_counts
    counts = trailing_history_counts(forecast_lookup(keys, fc), obs, 90, invert=invert)
    return percentile_scores(counts, nan_policy=nan_policy).first()["pct_precipitation"]


def test_percentile_of_score_goldens(spark):
    assert _risk(spark, [1.0, 2.0, 3.0, 3.0, 4.0], 3.0) == 70.0   # documented example
    assert _risk(spark, [1.0, 2.0, 3.0], 9.0) == 100.0            # above max
    assert _risk(spark, [1.0, 2.0, 3.0], 0.5) == 0.0              # below min
    assert abs(_risk(spark, [2.0, 2.0, 2.0], 2.0) - 66.66666666666667) < 1e-12  # all tied
    assert _risk(spark, [1.0, float("nan"), 3.0], 2.0) == -1.0     # NaN propagates
    assert _risk(spark, [1.0, float("nan"), 3.0], 2.0, "omit") == 50.0
    assert _risk(spark, [], 2.0) == -1.0                            # no history
    assert _risk(spark, [1.0, 2.0], float("nan")) == -1.0           # NaN forecast
    # inverted metric: a low score is the risky one
    assert _risk(spark, [1.0, 2.0, 3.0], 0.5, invert=("precipitation",)) == 100.0
    assert _risk(spark, [1.0, 2.0, 3.0, 3.0, 4.0], 3.0, invert=("precipitation",)) == 50.0


def test_busy_airport_list(spark):
    b = busy_airports(spark)
    assert b.count() == 50 and b.filter("iata = 'ATL'").count() == 1


def test_unpivot_positions(spark):
    df = spark.createDataFrame([(1, ([10, 20], [1.5, 2.5]))],
                               "cell long, hourly struct<time: array<long>, precipitation: array<double>>")
    rows = unpivot_hours(df, metrics=["precipitation"]).collect()
    assert [(r["hour_index"], r["ts_hour"], r["precipitation"]) for r in rows] == \
        [(0, 10, 1.5), (1, 20, 2.5)]


def test_landing_tables(spark, files, tmp_path):
    from flightlake.sources.landing import land_schedule, land_weather
    from flightlake.sources.versions import read_version

    out = str(tmp_path / "schedule_pq")
    land_schedule(spark, str(files / "schedule"), out, mode="overwrite")
    t = spark.read.parquet(out)
    assert t.count() == 9 and "flight_date" in t.columns
    r1 = t.filter("flight_iata = 'R1'").first()
    assert r1["departure_airport"] == "Alpha Intl" and r1["departure_epoch"] == 1709287200
    plan = t.filter("flight_date = '2024-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flight_date" in plan and "= 2024-03-01" in plan
    # landed tables are already clean: the status filter reaches the parquet scan
    ready = planner.prepare_schedule(t, normalize=False)
    plan = ready._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(flight_status), In(flight_status, [scheduled])" in plan \
        or "EqualTo(flight_status,scheduled)" in plan
    assert {r["flight_iata"] for r in planner.leg_metrics(ready, unique_airports(
        read_airports(spark, str(files / "airports.dat")))).collect()} == {"R1", "R8", "R9"}

    w = tmp_path / "w.json"
    hourly = {"time": [1709251200 + 3600 * i for i in range(30)]}
    for m in ["cloud_cover", "cloud_cover_high", "precipitation", "snow_depth", "visibility",
              "weather_code", "lifted_index"]:
        hourly[m] = [1.0] * 30
    w.write_text(json.dumps({"latitude": 1.0, "longitude": 2.0, "hourly": hourly}))
    wout = str(tmp_path / "weather_pq")
    land_weather(spark, str(w), wout, mode="overwrite")
    days = sorted(r["day"] for r in read_version(spark, wout).select("day").distinct().collect())
    assert days == [19783, 19784]
    # landing the same file again adds no row, a newer pull replaces the hours it holds
    land_weather(spark, str(w), wout)
    assert read_version(spark, wout).count() == 30
    hourly["precipitation"] = [9.0] * 30
    newer = tmp_path / "w2.json"
    newer.write_text(json.dumps({"latitude": 1.0, "longitude": 2.0, "hourly": {k: v[24:] for k, v in hourly.items()}}))
    import os
    os.utime(newer, (2_000_000_000, 2_000_000_000))
    land_weather(spark, str(newer), wout)
    values = sorted((r["ts_hour"], r["precipitation"]) for r in read_version(spark, wout).collect())
    assert len(values) == 30 and [p for _, p in values] == [1.0] * 24 + [9.0] * 6
    files = [f for _, _, names in os.walk(wout) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 4
    land_schedule(spark, str(files_again(files_dir := tmp_path / "again")), str(tmp_path / "s2"))
    land_schedule(spark, str(files_dir), str(tmp_path / "s2"))
    assert spark.read.parquet(str(tmp_path / "s2")).count() == 9


def files_again(folder):
    folder.mkdir()
    (folder / "p.json").write_text(json.dumps(SCHEDULE))
    return folder


def test_weather_latest_pull(spark):
    from flightlake.sources.weather import latest_pull
    rows = [(1, 0, 5.0, 1), (1, 0, 7.0, 2), (1, 0, 7.0, 2), (1, 3600, 3.0, 1), (2, 0, None, 4), (2, 0, 1.0, 3)]
    df = spark.createDataFrame(rows, "cell long, ts_hour long, precipitation double, pull long")
    got = sorted(tuple(r) for r in latest_pull(df, metrics=["precipitation"]).collect())
    assert [(c, t, p) for c, t, p, _ in got] == [(1, 0, 7.0), (1, 3600, 3.0), (2, 0, None)]


def test_grid_cell_edges(spark):
    from flightlake.functions.geo import grid_cell
    points = [(10.0, 180.0), (10.0, -180.0), (10.25, -180.0), (90.0, 0.0), (89.9, 0.0), (-90.0, -180.0), (0.1, 179.9)]
    df = spark.createDataFrame(points, "lat double, lon double").select(grid_cell("lat", "lon").alias("c"))
    c = [r.c for r in df.collect()]
    assert c[0] == c[1] != c[2] and c[3] == c[4] and c[5] == 0 and c[6] == 360 * 1440 + 1439


def test_markers_without_flight_numbers(spark):
    from flightlake.operators.markers import sorted_markers
    rows = [(None, "A", "B", 1.0, 2.0, 3.0, 4.0, 5, 6, "AA", "BB"), (None, "A", "C", None, None, 7.0, 8.0, 5, 6, "AA", "CC")]
    legs = spark.createDataFrame(rows, "flight_iata string, departure_airport string, arrival_airport string, "
                                       "departure_lat double, departure_lon double, arrival_lat double, arrival_lon double, "
                                       "departure_epoch long, arrival_epoch long, departure_iata string, arrival_iata string")
    got = [tuple(r) for r in sorted_markers(legs).collect()]
    assert got == [("departure", "A", 1.0, 2.0), ("arrival", "B", 3.0, 4.0), ("arrival", "C", 7.0, 8.0)]


def test_legs_with_null_numbers_keep_their_own_paths(spark):
    from flightlake.plans import planner as plan
    rows = [(i, j, float(i), 0.0, j, 1.0, "white") for i in range(400) for j in range(4)]
    scored = spark.createDataFrame(rows, "leg_id long, idx int, lat double, lon double, t long, risk double, band string")
    sizes = [len(r.path) for r in plan.path_with_risk(scored).collect()]
    assert sizes == [4] * 400
