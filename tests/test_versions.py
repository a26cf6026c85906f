"""Versioned weather: crashes, readers and landings beside each other, issues, and plans pinned to versions."""

import json
import os

import pytest
from pyspark.sql import functions as F

from flightlake.operators.lookup import unique_airports
from flightlake.operators.weather_risk import forecast_lookup
from flightlake.sources import landing, versions
from flightlake.sources.weather import read_forecast, read_weather
from flightlake.streaming import refresh
from tests.test_streaming import _env

DAY, HOUR, DAY0 = 86400, 3600, 19783
METRICS = ["cloud_cover", "cloud_cover_high", "precipitation", "snow_depth", "visibility", "weather_code", "lifted_index"]


def _response(folder, name, value, first=0, hours=48, lat=1.0, lon=2.0):
    folder.mkdir(parents=True, exist_ok=True)
    hourly = {"time": [DAY0 * DAY + HOUR * (first + i) for i in range(hours)]} | {m: [value] * hours for m in METRICS}
    (folder / f"{name}.json").write_text(json.dumps({"latitude": lat, "longitude": lon, "hourly": hourly}))
    return str(folder)


def _values(df):
    return {(r.cell, r.ts_hour): r.precipitation for r in df.collect()}


def test_versions_and_readers(spark, tmp_path):
    table = str(tmp_path / "weather")
    first = landing.land_weather(spark, _response(tmp_path / "a" / "pull=20240301T000000", "x", 1.0), table)
    assert (first.number, sorted(first.parts)) == (1, [str(DAY0), str(DAY0 + 1)])
    reader = versions.read_version(spark, table)
    second = landing.land_weather(spark, _response(tmp_path / "b" / "pull=20240302T000000", "x", 2.0, 24, 48), table)
    assert second.number == 2 and second.parts[str(DAY0)] == first.parts[str(DAY0)]
    assert set(_values(reader).values()) == {1.0} and reader.count() == 48  # planned before, read after the landing
    now = _values(versions.read_version(spark, table))
    assert len(now) == 72 and sum(v == 2.0 for v in now.values()) == 48
    assert _values(versions.read_version(spark, table, 1)) == _values(reader)
    # an older pull that is landed late adds hours and replaces none, wherever its files were copied
    old = _response(tmp_path / "c" / "pull=20240229T000000", "x", 0.5, -24, 96)
    os.utime(tmp_path / "c" / "pull=20240229T000000" / "x.json", (2_000_000_000, 2_000_000_000))
    landing.land_weather(spark, old, table)
    late = _values(versions.read_version(spark, table))
    assert {k: v for k, v in late.items() if k in now} == now and len(late) == 96
    assert versions.expire(spark, table, 1) and versions.version_numbers(spark, table) == [3]
    assert _values(versions.read_version(spark, table)) == late


@pytest.mark.parametrize("step", ["write", "commit", "rename"])
def test_crash_at_every_step(spark, tmp_path, monkeypatch, step):
    table = str(tmp_path / "weather")
    landing.land_weather(spark, _response(tmp_path / "a" / "pull=1", "x", 1.0), table)
    before = _values(versions.read_version(spark, table))
    newer = _response(tmp_path / "b" / "pull=2", "x", 2.0)
    with monkeypatch.context() as m:
        if step == "write":
            broken = lambda df: df.withColumn("precipitation", F.expr("CAST(raise_error('disk') AS DOUBLE)"))
            m.setattr(landing, "_cells_together", broken)
        else:
            def crash(*_):
                raise RuntimeError("crash")
            m.setattr(versions, {"commit": "commit", "rename": "_rename"}[step], crash)
        with pytest.raises(Exception, match="disk|crash"):
            landing.land_weather(spark, newer, table)
    assert versions.version_numbers(spark, table) == [1]
    assert _values(versions.read_version(spark, table)) == before
    landing.land_weather(spark, newer, table)
    assert set(_values(versions.read_version(spark, table)).values()) == {2.0}
    versions.expire(spark, table, 1)  # what the crash left behind goes
    assert len([n for n in os.listdir(table) if n.startswith("version=")]) == 1


def test_two_landings_from_one_version(spark, tmp_path, monkeypatch):
    """The landing that comes second merges again with what the first one committed."""
    table = str(tmp_path / "weather")
    landing.land_weather(spark, _response(tmp_path / "a" / "pull=1", "x", 1.0), table)
    other = _response(tmp_path / "b" / "pull=2", "x", 2.0, lon=50.0)
    commit, raced = versions.commit, []

    def late(*args):
        if not raced:
            raced.append(True)
            landing.land_weather(spark, other, table)
        return commit(*args)

    monkeypatch.setattr(versions, "commit", late)
    done = landing.land_weather(spark, _response(tmp_path / "c" / "pull=3", "x", 3.0), table)
    got = _values(versions.read_version(spark, table))
    assert done.number == 3 and sorted(got.values()) == [2.0] * 48 + [3.0] * 48


def test_forecast_issues(spark, tmp_path):
    table = str(tmp_path / "forecast")
    for issue, value in (("20240229T060000", 1.0), ("20240301T060000", 2.0)):
        folder = _response(tmp_path / value.hex() / f"issue={issue}", "x", value, 0, 48)
        landing.land_forecast(spark, folder, table)
        landing.land_forecast(spark, folder, table)  # landed twice: no other result
    issues = versions.read_version(spark, table)
    cell = issues.first().cell
    t1, t2 = 1709186400, 1709272800
    assert sorted({r.issue for r in issues.collect()}) == [t1, t2]
    keys = spark.createDataFrame([(cell, DAY0 * DAY + HOUR * h, asked) for h in (0, 30) for asked in (t1 - 1, t1, t2 - 1, t2, None)],
                                 "cell long, fts long, asked long")
    got = forecast_lookup(keys, issues, ["precipitation"], F.col("asked")).collect()
    want = {t1 - 1: None, t1: 1.0, t2 - 1: 1.0, t2: 2.0, None: None}
    assert len(got) == 10 and all(r.s_precipitation == want[r.asked] for r in got)
    for as_of in (t1 - 1, t1, t2):
        got = forecast_lookup(keys, issues, ["precipitation"], as_of).collect()
        assert len(got) == 10 and all(r.s_precipitation == want[as_of] for r in got)
    assert all(r.s_precipitation == 2.0 for r in forecast_lookup(keys, issues, ["precipitation"]).collect())


def test_observed_and_forecast_are_told_apart(spark, tmp_path):
    late = _response(tmp_path / "seen" / "pull=20240310T000000", "x", 9.0)
    ahead = _response(tmp_path / "ahead" / "issue=20240229T060000", "x", 1.0)
    assert "issue" not in read_weather(spark, late).columns
    landing.land_weather(spark, late, str(tmp_path / "w"))
    landing.land_forecast(spark, ahead, str(tmp_path / "f"))
    f = versions.read_version(spark, str(tmp_path / "f"))
    assert set(_values(f).values()) == {1.0} and read_forecast(spark, ahead).count() == 48
    keys = f.select("cell", F.col("ts_hour").alias("fts"))
    assert {r.s_precipitation for r in forecast_lookup(keys, f, ["precipitation"], 1709186400).collect()} == {1.0}


@pytest.fixture
def uniq(spark):
    rows = [("AAA", "Alpha", 1.0, 2.0), ("BBB", "Beta", 1.0, 2.1)]
    return unique_airports(spark.createDataFrame(rows, "iata string, name string, latitude double, longitude double"))


def _weather(spark, tmp_path, name, forecast):
    """Observed 0, 1, 2, ... over two days, and one forecast value for all hours."""
    table = str(tmp_path / "w")
    if not versions.is_versioned(spark, table):
        folder = tmp_path / "seen" / "pull=1"
        hours = [DAY0 * DAY + HOUR * h for h in range(-24, 24)]
        folder.mkdir(parents=True)
        for lon in (2.0, 2.1):
            hourly = {"time": hours} | {m: [float(i) for i in range(48)] for m in METRICS}
            (folder / f"{lon}.json").write_text(json.dumps({"latitude": 1.0, "longitude": lon, "hourly": hourly}))
        landing.land_weather(spark, str(tmp_path / "seen"), table)
    for lon in (2.0, 2.1):
        _response(tmp_path / name / f"issue={1700000000 + int(forecast)}", f"x{lon}", forecast, 0, 48, 1.0, lon)
    landing.land_forecast(spark, str(tmp_path / name), str(tmp_path / "f"))
    return table, str(tmp_path / "f")


def test_weather_landed_between_two_batches_of_a_running_query(spark, tmp_path, uniq):
    land, out = tmp_path / "land", str(tmp_path / "out")
    land.mkdir()
    w, f = _weather(spark, tmp_path, "one", 5.0)
    q = refresh.start_refresh(spark, str(land), out, str(tmp_path / "ck"), uniq, w, f, past_days=1, available_now=False,
                              processing_time="0 seconds", now=lambda: 1710000000)
    try:
        (land / "a.json").write_text(_env([("F1", "AAA", "BBB")]))
        q.processAllAvailable()
        first = refresh.read_current_plan(spark, out).collect()
        _weather(spark, tmp_path, "two", 40.0)
        (land / "b.json").write_text(_env([("F1", "AAA", "BBB")]))
        q.processAllAvailable()
        second = refresh.read_current_plan(spark, out).collect()
    finally:
        q.stop()
    assert len(first) == len(second) == 4
    assert {r.risk for r in first} == {12.5} and {r.risk for r in second} == {85.4}
    markers = spark.read.json(out + "/_versions/*").orderBy("epoch").collect()
    assert [(r.observed_version, r.forecast_version, r.as_of) for r in markers] == [(1, 1, 1710000000), (1, 2, 1710000000)]


def test_an_epoch_run_again_gives_the_same_plan(spark, tmp_path, uniq, monkeypatch):
    out = str(tmp_path / "out")
    w, f = _weather(spark, tmp_path, "one", 5.0)
    (tmp_path / "e.json").write_text(_env([("F1", "AAA", "BBB")]))
    batch = spark.read.schema(refresh.SCHEDULE_ENVELOPE).option("multiLine", True).json(str(tmp_path / "e.json"))
    args = (batch, 7, out, uniq, w, f, lambda: 1710000000)
    options = {"cell_fn": refresh.planner.default_cell, "past_days": 1}
    with monkeypatch.context() as m:  # the plan is written, its marker is not
        m.setattr(refresh, "MARKERS", "x" * 300)
        with pytest.raises(Exception):
            refresh.plan_epoch(*args, **options)
    assert refresh.read_current_plan(spark, out) is None
    lost = spark.read.parquet(out + "/v00000007").collect()
    _weather(spark, tmp_path, "two", 40.0)
    refresh.plan_epoch(*args[:-1], lambda: 1720000000, **options)
    assert sorted(map(tuple, refresh.read_current_plan(spark, out).collect())) == sorted(map(tuple, lost))
    # a later epoch sees the new forecast, but not an issue after its time
    refresh.plan_epoch(batch, 8, *args[2:-1], lambda: 1700000006, **options)
    assert {r.risk for r in refresh.read_current_plan(spark, out).collect()} == {12.5}
    refresh.plan_epoch(batch, 9, *args[2:-1], lambda: 1720000000, **options)
    assert {r.risk for r in refresh.read_current_plan(spark, out).collect()} == {85.4}
