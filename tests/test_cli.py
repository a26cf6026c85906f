"""The command line runs each job end to end on hand-made payloads."""

import json

from flightlake.__main__ import main
from tests.test_goldens import AIRPORTS_DAT, BOARD, SCHEDULE, _detail


def ckpt_runs(spark):
    from pathlib import Path

    from flightlake.session import checkpoint_dir
    return Path(checkpoint_dir(spark)).glob("run-*")


def test_cli_jobs(spark, tmp_path):
    (tmp_path / "airports.dat").write_text(AIRPORTS_DAT)
    (tmp_path / "sched").mkdir()
    (tmp_path / "sched" / "p.json").write_text(json.dumps(SCHEDULE))
    (tmp_path / "sched" / "broken.json").write_text('{"pagination": {"count": 1}, "data": [')
    (tmp_path / "board.json").write_text(json.dumps(BOARD))
    (tmp_path / "detail.json").write_text("\n".join(json.dumps(_detail(f, n)) for f, n in
                                                    (("f1", 1), ("f11", 11))))
    hours = [(1, 1709251200 - 3600 * i, float(i % 5), 1.0, 0.0) for i in range(200)]
    spark.createDataFrame(hours, "cell long, ts_hour long, precipitation double, "
                                 "visibility double, snow_depth double") \
        .write.parquet(str(tmp_path / "weather"))
    a, out = str(tmp_path / "airports.dat"), str(tmp_path / "out")

    main(["plan", "--schedule", str(tmp_path / "sched"), "--airports", a,
          "--weather", str(tmp_path / "weather"), "--forecast", str(tmp_path / "weather"), "--past-days", "7", "--out", out + "/plan"])
    wp = spark.read.parquet(out + "/plan/waypoints")
    assert {r.flight_iata for r in wp.select("flight_iata").distinct().collect()} == {"R1", "R8", "R9"}
    table = spark.read.parquet(out + "/plan/plan")
    assert table.count() == 3 and {"flight_path", "risk_path", "airport_distance", "departure_lat"} <= set(table.columns)
    assert spark.read.parquet(out + "/plan/rejects").where("reject_reason IS NULL").count() == 0
    losses = {(r.stage, r.reason): r.n for r in spark.read.parquet(out + "/plan/losses").collect()}
    assert losses["files", "read"] == 2 and losses["files", "broken"] == 1
    gone = losses["records", "no_status"] + losses["records", "other_status"] \
        + sum(n for (stage, _), n in losses.items() if stage == "rejected")
    assert losses["records", "read"] == len(SCHEDULE["data"]) == gone + losses["planned", "legs"]
    assert losses["planned", "legs"] == 3 and spark.read.parquet(out + "/plan/rejects").count() > 0
    assert not list(ckpt_runs(spark))  # intermediates go with the job
    assert wp.count() == 12 and spark.read.parquet(out + "/plan/markers").count() > 0

    main(["board", "--boards", str(tmp_path / "board.json"), "--airports", a,
          "--out", out + "/board", "--format", "csv"])
    assert spark.read.option("header", True).csv(out + "/board/arrivals").count() == 3

    main(["track", "--details", str(tmp_path / "detail.json"), "--json-lines",
          "--out", out + "/track"])
    assert spark.read.parquet(out + "/track/trail").count() == 3
    assert spark.read.parquet(out + "/track/future_path").count() == 8
