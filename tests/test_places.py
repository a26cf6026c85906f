"""Weather files clustered by place (S6, S7): a plan reads the row groups of its region only."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from flightlake.functions.geo import cell_place, grid_cell
from flightlake.operators.places import GRID_COLUMNS, PLACE_COLUMN, bound_to_places, joined_stretches, tile_bits
from flightlake.operators.weather_risk import score_waypoints
from flightlake.schemas import SCORED_METRICS
from flightlake.sources import landing, versions

DAY, DAY0 = 86400, 19783


def _globe(spark, resolution=1.0, hours=4):
    """Hours of every cell, a value that tells the cell."""
    n = int(360 / resolution * 180 / resolution)
    rows = spark.range(n * hours).selectExpr(f"id % {n} AS cell", f"{DAY0 * DAY} + 3600L * (id div {n}) AS ts_hour")
    rows = rows.withColumns({m: (F.col("cell") % 101).cast("double") for m in SCORED_METRICS})
    return landing._placed(landing._by_day(rows), resolution)


def _land(spark, path, rows):
    versions.land(spark, path, rows, "day", None, landing._cells_together, row_group_bytes=8 << 10)
    return versions.read_version(spark, path)


def _scanned_rows(df):
    """Rows that the parquet scans of an executed plan put out."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_place_interleaves_row_and_column(spark):
    n_lon = 1440
    cells = [0, 1, 1439, 1440, 719 * 1440 + 1439, 300 * 1440 + 77]
    got = spark.createDataFrame([(c,) for c in cells], "cell long").select("cell", cell_place("cell", n_lon).alias("p")).collect()
    for r in got:
        row, col = divmod(r.cell, n_lon)
        assert r.p == sum(((col >> i & 1) << 2 * i) | ((row >> i & 1) << 2 * i + 1) for i in range(16))


def test_stretches_cover_all_tiles():
    assert joined_stretches([]) == []
    assert joined_stretches([5, 3, 4, 9]) == [(3, 5), (9, 9)]
    assert joined_stretches([1, 3, 10, 30], most=2) == [(1, 10), (30, 30)]
    assert joined_stretches([1, 3, 10, 30], most=1) == [(1, 30)]
    assert tile_bits(12) == 0 and tile_bits(1440) == 8 and tile_bits(36000) > tile_bits(1440)


def test_ten_cells_read_few_row_groups(spark, tmp_path):
    weather = _land(spark, str(tmp_path / "w"), _globe(spark))
    assert weather.schema[PLACE_COLUMN].metadata == {GRID_COLUMNS: 360}
    total = weather.count()
    keys = spark.createDataFrame([(48.0 + k // 5, 8.0 + k % 5) for k in range(10)], "lat double, lon double") \
        .select(grid_cell("lat", "lon", 1.0).alias("cell"))
    near = bound_to_places(weather, keys)
    assert _scanned_rows(near) < 0.05 * total
    wanted = {r.cell for r in keys.collect()}
    assert near.join(keys, "cell").count() == 10 * 4 and {r.cell for r in near.select("cell").collect()} >= wanted
    # the same from the files: row groups whose places meet those of the ten cells
    places = [r.place for r in weather.join(F.broadcast(keys), "cell").select("place").distinct().collect()]
    groups, met = 0, 0
    for name in glob.glob(f"{tmp_path}/w/version=*/day=*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("place")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            groups, met = groups + 1, met + any(stats.min <= p <= stats.max for p in places)
    assert groups >= 40 and met < 0.05 * groups


def test_scores_are_the_same_with_and_without_places(spark, tmp_path):
    weather = _land(spark, str(tmp_path / "w"), _globe(spark, 30.0, 24))
    # both sides of the antimeridian, the poles, a place off every cell
    points = spark.createDataFrame(
        [(lat, lon, DAY0 * DAY + 3600 * h, DAY0 * DAY) for h, (lat, lon) in enumerate(
            [(0.0, 179.9), (0.0, -179.9), (90.0, 0.0), (-90.0, 10.0), (51.5, -0.1), (-33.9, 151.2)])],
        "lat double, lon double, t long, leg_start long").withColumn("cell", grid_cell("lat", "lon", 30.0))
    points = points.unionByName(points.limit(1).withColumn("cell", F.lit(None).cast("long")))
    plain = weather.drop(PLACE_COLUMN)
    got = [sorted(score_waypoints(points, w, w, 1).select("lat", "lon", "risk").collect()) for w in (weather, plain)]
    assert got[0] == got[1] and any(r.risk >= 0 for r in got[0])


def test_rows_without_place_stay_and_no_keys_read_nothing(spark, tmp_path):
    rows = _globe(spark, 30.0, 1)
    meta = {GRID_COLUMNS: 12}
    holes = rows.withColumn(PLACE_COLUMN, F.when(F.col("cell") % 2 == 0, F.col(PLACE_COLUMN)).alias(PLACE_COLUMN, metadata=meta))
    keys = spark.createDataFrame([(4,)], "cell long")
    assert {r.cell for r in bound_to_places(holes, keys).collect()} >= {4, *range(1, 72, 2)}
    assert bound_to_places(rows, keys.limit(0)).count() == 0
