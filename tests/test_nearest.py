"""Nearest weather point by grid rings against a comparison with every station."""

import math
import random

import pytest

from flightlake.operators.nearest import nearest_point


def _km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    s, t = math.sin((q - p) / 2), math.sin((math.radians(d) - math.radians(b)) / 2)
    h = min(s * s + math.cos(p) * math.cos(q) * t * t, 1.0)
    return round(6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h)), 4)


def _places(rng, n):
    special = [(90.0, 0.0), (-90.0, 10.0), (89.99, 170.0), (-89.5, -100.0), (0.0, 180.0), (0.0, -180.0), (12.0, 179.99),
               (12.0, -179.99), (45.0, 0.0), (0.0, 0.0)]
    near_pole = [(rng.choice([-1, 1]) * (90 - rng.random() * 3), rng.uniform(-180, 180)) for _ in range(n // 4)]
    dateline = [(rng.uniform(-70, 70), rng.choice([-1, 1]) * (180 - rng.random() * 2)) for _ in range(n // 4)]
    return special + near_pole + dateline + [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]


@pytest.mark.parametrize("max_km", [5.0, 150.0, 900.0, 7000.0, 20100.0])
def test_against_every_station(spark, max_km):
    rng = random.Random(int(max_km))
    stations = [(i, *p) for i, p in enumerate(_places(rng, 150))]
    points = [(i, *p) for i, p in enumerate(_places(rng, 120) + [(s[1] + 0.01, s[2]) for s in stations[20:60] if s[1] < 89])]
    points += [(-1, None, 3.0), (-2, math.nan, 1.0), (-3, 1.0, None)]
    got = nearest_point(spark.createDataFrame(points, "id long, lat double, lon double"),
                        spark.createDataFrame(stations + [(999, None, None)], "station long, station_lat double, station_lon double"),
                        max_km, max_broadcast_points=0 if max_km == 150.0 else 10**6).collect()
    assert len(got) == len(points)
    by_id = {p[0]: p for p in points}
    for r in got:
        _, lat, lon = by_id[r.id]
        if lat is None or lon is None or math.isnan(lat):
            assert r.station is None and r.station_km is None
            continue
        near = sorted((_km(lat, lon, s[1], s[2]), s[0]) for s in stations)[0]
        if near[0] > max_km:
            assert r.station is None
        else:
            assert r.station_km == pytest.approx(near[0], abs=2e-4)
            assert _km(lat, lon, *stations[r.station][1:]) == pytest.approx(near[0], abs=2e-4)


def test_ties_go_to_the_smaller_station(spark):
    stations = spark.createDataFrame([(7, 1.0, 1.0), (3, 1.0, 1.0)], "station long, station_lat double, station_lon double")
    row = nearest_point(spark.createDataFrame([(1.0, 1.0)], "lat double, lon double"), stations, 1.0).first()
    assert (row.station, row.station_km) == (3, 0.0)
