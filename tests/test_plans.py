"""Physical-plan properties of the registered queries."""

import pytest

from tests.conftest import SF_SMALL

BANNED = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
          "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _keys():
    from flightlake.catalog import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _keys())
def test_no_python_and_no_cross_join(spark, name):
    from __spark_entry__ import queries
    plan = _plan(queries()[name](spark, SF_SMALL))
    for token in BANNED:
        assert token not in plan, f"{name}: {token} in plan"


def test_airport_lookup_is_broadcast_and_pruned(spark):
    from __spark_entry__ import queries
    df = queries()["resolve_airports"](spark, SF_SMALL)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    # only the four orders columns the schedule view needs are read
    assert "o_totalprice" not in plan and "o_orderdate" not in plan


def test_status_filter_reaches_the_scan(spark, tmp_path):
    from flightlake.sources.schedule import scheduled_only
    path = str(tmp_path / "s")
    spark.createDataFrame([("a", "scheduled"), ("b", None)], "flight_iata string, flight_status string").write.parquet(path)
    plan = _plan(scheduled_only(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(flight_status), EqualTo(flight_status,scheduled)]" in plan \
        or "PushedFilters: [In(flight_status, [scheduled])]" in plan


def test_history_is_shuffled_once_by_blocks(spark):
    """Without broadcasts: joined on (cell, block); no row per key and history hour, no copy per window day."""
    import re

    from flightlake.operators.weather_risk import key_risk

    metrics = "precipitation double, visibility double, snow_depth double"
    day = 86400
    keys = spark.createDataFrame([(1, day * (19750 + d), day * (19750 + d) + 3600 * h) for d in range(40) for h in range(5)],
                                 "cell long, day0 long, fts long")
    hours = [(1, day * (19600 + d) + 3600 * h, float(d % 7), float(h), 0.0) for d in range(250) for h in range(24)]
    w = spark.createDataFrame(hours, f"cell long, ts_hour long, {metrics}")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        risk = key_risk(keys, w, w)
        plan = _plan(risk).split("Initial Plan")[-1]
        joins = re.findall(r"SortMergeJoin \[(.*?)\], \[(.*?)\]", plan)
        names = [re.sub(r"#\d+L?", "", a) for a, _ in joins]
        assert names == ["cell, block", "cell, fts"]
        # history (1), forecast and its keys (2), keys by (cell, day0), their blocks, counts by key
        assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 6
        assert plan.count("Generate explode") == 2 and "Window" not in plan and "Cartesian" not in plan
        before = _rows_shuffled(spark, risk)
        assert before <= len(hours) * 2 + 200 * 5  # history and forecast once each, keys a few times
        assert risk.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def _rows_shuffled(spark, df):
    """Rows written to exchanges when ``df`` is executed (SQL metrics of the executed plan)."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStage", "BroadcastQueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_paths_are_put_together_without_an_exchange_of_waypoints(spark):
    """With a broadcast risk table only legs are shuffled, by id: 4 points a leg, but one row a leg in each exchange."""
    import re

    from flightlake import catalog
    from flightlake.plans import planner
    from flightlake.sources import fixtures as fx

    legs = planner.identified(catalog._planned_legs(spark, SF_SMALL))
    w = fx.weather_v(spark, SF_SMALL)
    table = planner.planner_table(legs, w, w, cell_fn=fx.fixture_cell)
    plan = _plan(table).split("Initial Plan")[-1]
    by_id = [x for x in plan.split("\n") if "Exchange hashpartitioning(leg_id" in x]
    assert len(by_id) == 2 and all("REPARTITION_BY_COL" in x for x in by_id), by_id
    # above the generated points there is no exchange but the broadcast of the risk table
    assert not re.search(r"Exchange hashpartitioning\((?!leg_id|cell|event)", plan)
    n = legs.count()
    assert table.count() == n and table.selectExpr("sum(size(risk_path))").first()[0] == 4 * n


def test_size_check_moves_no_rows_to_one_task(spark):
    from flightlake.operators.broadcast import is_bounded
    df = spark.range(5000)
    assert is_bounded(df, 5000) and not is_bounded(df, 4999)
    plan = _plan(df.groupBy().count())
    assert "GlobalLimit" not in plan and "partial_count" in plan


def test_weather_scan_prunes_day_partitions(spark, tmp_path):
    """A day-partitioned weather table is read only for the days the keys need."""
    from pyspark.sql import functions as F

    from flightlake.operators.weather_risk import key_risk

    day = 86400
    rows = [(1, d * day + h * 3600, float(h), 1.0, 0.0) for d in range(19700, 19760) for h in (0, 12)]
    w = spark.createDataFrame(rows, "cell long, ts_hour long, precipitation double, "
                                    "visibility double, snow_depth double")
    path = str(tmp_path / "weather")
    w.withColumn("day", F.floor(F.col("ts_hour") / day)).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    keys = spark.createDataFrame([(1, 19750 * day, 19750 * day + 7200)], "cell long, day0 long, fts long")
    risk = key_risk(keys, stored, stored, past_days=7, prune_weather=True)
    plan = risk._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan and ">= 19743" in plan
    assert risk.count() == 1
    got = risk.first()
    full = key_risk(keys, stored, stored, past_days=7, prune_weather=False).first()
    assert got["risk"] == full["risk"]


def test_join_back_broadcast_and_salted_paths_agree(spark):
    """Small risk tables are broadcast; the salted shuffle path gives the same rows."""
    from flightlake import catalog
    from flightlake.operators.weather_risk import score_waypoints
    from flightlake.sources import fixtures as fx

    pts = catalog.planner.waypoints(catalog._planned_legs(spark, SF_SMALL)).withColumn(
        "cell", fx.fixture_cell("lat", "lon"))
    w = fx.weather_v(spark, SF_SMALL)
    small = score_waypoints(pts, w, w)
    salted = score_waypoints(pts, w, w, max_broadcast_keys=0, salt_buckets=4, hot_key_points=2)
    assert "BroadcastHashJoin" in _plan(small)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect()))


def test_airport_lookup_shuffle_fallback_gives_same_rows(spark):
    """Above the broadcast bound the lookup shuffles; the result is the same."""
    from flightlake.operators.lookup import resolve_airports, unique_airports
    from flightlake.sources import fixtures as fx

    flights = fx.schedule_v(spark, SF_SMALL)
    uniq = unique_airports(fx.airports_v(spark, SF_SMALL))
    small = resolve_airports(flights, uniq)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = resolve_airports(flights, uniq, max_broadcast_rows=1)
        plan = _plan(big)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert sorted(map(repr, big.collect())) == sorted(map(repr, small.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
