"""Refresh stream: files picked up once, empty pulls keep the last good plan."""

import json

from pyspark.sql import functions as F

from flightlake.operators.lookup import unique_airports
from flightlake.streaming.refresh import read_current_plan, start_refresh


def _env(flights):
    data = [{"flight_date": "2024-03-01", "flight_status": "scheduled",
             "departure": {"airport": "A", "iata": d, "scheduled": "2024-03-01T10:00:00"},
             "arrival": {"airport": "B", "iata": a, "scheduled": "2024-03-01T13:00:00"},
             "airline": {"name": "X"}, "flight": {"iata": fid}} for fid, d, a in flights]
    return json.dumps({"pagination": {"count": len(data)}, "data": data})


def test_refresh_stream(spark, tmp_path):
    land, out, ck = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "ck")
    land.mkdir()
    airports = spark.createDataFrame(
        [("AAA", "Alpha", 10.0, 20.0), ("BBB", "Beta", -5.0, 30.0)],
        "iata string, name string, latitude double, longitude double")
    uniq = unique_airports(airports)
    weather = spark.createDataFrame([(0, 1709251200, 1.0, 2.0, 3.0)],
                                    "cell long, ts_hour long, precipitation double, "
                                    "visibility double, snow_depth double")

    def run():
        q = start_refresh(spark, str(land), out, ck, uniq, weather, weather, past_days=1)
        q.awaitTermination(120)
        assert q.exception() is None

    assert read_current_plan(spark, out) is None
    # two pulls between runs: only the newer one is planned, with all its pages
    for pull, page, flight in (("1", "a", "F0"), ("2", "a", "F1"), ("2", "b", "F2")):
        (land / f"pull={pull}").mkdir(exist_ok=True)
        (land / f"pull={pull}" / f"{page}.json").write_text(_env([(flight, "AAA", "BBB")]))
    run()
    first = read_current_plan(spark, out)
    assert sorted({r.flight_iata for r in first.collect()}) == ["F1", "F2"]
    # a plan that was written without its marker (a crash in between) is not current
    first.limit(0).write.parquet(out + "/v99999999")
    assert read_current_plan(spark, out).count() == 8

    (land / "pull=3").mkdir()
    (land / "pull=3" / "a.json").write_text(_env([("F3", "AAA", "BBB")]))
    run()
    second = read_current_plan(spark, out)
    assert {r.flight_iata for r in second.collect()} == {"F3"}  # only the new file
    assert second.count() == 4

    (land / "pull=4").mkdir()
    (land / "pull=4" / "a.json").write_text(json.dumps({"pagination": {"count": 0}, "data": []}))
    run()
    third = read_current_plan(spark, out)
    assert {r.flight_iata for r in third.collect()} == {"F3"}  # empty pull ignored


def test_failed_batch_is_replanned(spark, tmp_path):
    """A batch that fails is not committed: the next run plans the same files again."""
    land, out, ck = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "ck")
    land.mkdir()
    airports = spark.createDataFrame(
        [("AAA", "Alpha", 10.0, 20.0), ("BBB", "Beta", -5.0, 30.0)],
        "iata string, name string, latitude double, longitude double")
    uniq = unique_airports(airports)
    good = spark.createDataFrame([(0, 1709251200, 1.0, 2.0, 3.0)],
                                 "cell long, ts_hour long, precipitation double, "
                                 "visibility double, snow_depth double")
    # a weather source that fails while the batch runs
    broken = good.withColumn(
        "precipitation", F.expr("CAST(raise_error('weather source unavailable') AS DOUBLE)"))

    (land / "p1.json").write_text(_env([("F1", "AAA", "BBB")]))
    q = start_refresh(spark, str(land), out, ck, uniq, broken, broken, past_days=1)
    try:
        q.awaitTermination(120)
    except Exception:  # noqa: BLE001 - the failing batch surfaces here
        pass
    assert q.exception() is not None
    assert read_current_plan(spark, out) is None

    q = start_refresh(spark, str(land), out, ck, uniq, good, good, past_days=1)
    q.awaitTermination(120)
    assert q.exception() is None
    plan = read_current_plan(spark, out)
    assert {r.flight_iata for r in plan.collect()} == {"F1"} and plan.count() == 4
