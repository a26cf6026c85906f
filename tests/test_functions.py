"""Scalar expressions against small pure-Python formulas, plus property checks.

Cases are generated in bulk (numpy / hypothesis) and evaluated in one Spark job.
"""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.functions.geo import haversine_km, path_points, segment_count
from flightlake.functions.risk import percentile_of_score, risk_band
from flightlake.functions.text import normalize_text
from flightlake.functions.timefn import hour_offset


def ref_haversine(lat1, lon1, lat2, lon2):
    p1, q1, p2, q2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((q2 - q1) / 2) ** 2
    a = min(a, 1.0)
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def ref_path(lat0, lon0, lat1, lon1, t0, t1, n=3):
    fr = np.array([i * (1.0 / n) for i in range(n)] + [1.0])
    lat = np.degrees(math.radians(lat0) + fr * (math.radians(lat1) - math.radians(lat0)))
    lon = np.degrees(math.radians(lon0) + fr * (math.radians(lon1) - math.radians(lon0)))
    t = (t0 + fr * (t1 - t0) + 0.5).astype(int)
    return [(i, float(np.round(a, 5)), float(np.round(b, 5)), int(c))
            for i, (a, b, c) in enumerate(zip(lat, lon, t))]


def ref_pos(hist, s):
    n = len(hist)
    left = sum(v < s for v in hist)
    right = sum(v <= s for v in hist)
    return (left + right + (1 if left < right else 0)) * (50.0 / n)


def test_haversine_and_path_parity(spark):
    rng = np.random.default_rng(7)
    rows = []
    for _ in range(400):
        lat0, lat1 = rng.uniform(-89, 89, 2).round(4)
        lon0, lon1 = rng.uniform(-179, 179, 2).round(4)
        t0 = int(rng.integers(1_700_000_000, 1_710_000_000))
        t1 = t0 + int(rng.integers(-20_000, 60_000))
        rows.append((float(lat0), float(lon0), float(lat1), float(lon1), t0, t1))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, t0 long, t1 long")
    got = df.select("*", haversine_km("a", "b", "c", "d").alias("km"),
                    path_points("a", "b", "c", "d", "t0", "t1").alias("p")).collect()
    for r in got:
        exp = ref_haversine(r.a, r.b, r.c, r.d)
        assert abs(r.km - exp) <= 0.5e-4 + 1e-9
        assert [tuple(p) for p in r.p] == ref_path(r.a, r.b, r.c, r.d, r.t0, r.t1)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180), st.floats(-90, 90),
                          st.floats(-180, 180)), min_size=1, max_size=30))
def test_haversine_properties(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    got = df.select(haversine_km("a", "b", "c", "d", digits=None).alias("x"),
                    haversine_km("c", "d", "a", "b", digits=None).alias("y")).collect()
    for r in got:
        assert 0.0 <= r.x <= math.pi * 6371.0 + 1e-6
        assert abs(r.x - r.y) < 1e-6


def test_percentile_formula_parity(spark):
    rng = np.random.default_rng(11)
    cases = []
    for _ in range(300):
        hist = [float(v) for v in rng.integers(0, 6, rng.integers(1, 30))]
        s = float(rng.integers(-1, 7))
        cases.append((hist, s))
    df = spark.createDataFrame([(h, s) for h, s in cases], "h array<double>, s double")
    lt = F.size(F.filter("h", lambda v: v < F.col("s")))
    le = F.size(F.filter("h", lambda v: v <= F.col("s")))
    got = df.select(percentile_of_score(lt, le, F.size("h")).alias("p")).collect()
    for (hist, s), r in zip(cases, got):
        exp = ref_pos(hist, s)
        assert r.p == exp
        assert 0.0 <= r.p <= 100.0
        # above every value, or the unique maximum, ranks at 100
        if s > max(hist) or (s == max(hist) and hist.count(s) == 1):
            assert r.p == 100.0


def test_band_and_segments(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (74.9, 9.99), (75.0, 10.0), (89.9, 305.0),
                                (90.0, 1e6)], "r double, km double")
    got = df.select(risk_band("r").alias("b"), segment_count("km").alias("n")).collect()
    assert [r.b for r in got] == ["white", "white", "orange", "orange", "red"]
    assert [r.n for r in got] == [1, 1, 1, 30, 30]


def test_hour_offset_truncates(spark):
    df = spark.createDataFrame([(100, 100), (3699, 100), (3700, 100), (7299, 100)], "e long, s long")
    assert [r.h for r in df.select(hour_offset("e", "s").alias("h")).collect()] == [1, 1, 2, 2]


WS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        　"


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab,.-é") + list(WS) + ["​"]),
                        max_size=25), min_size=1, max_size=20))
def test_whitespace_matches_python_split(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(normalize_text("s").alias("n"),
                    normalize_text(normalize_text("s")).alias("nn")).collect()
    for t, r in zip(texts, got):
        assert r.n == " ".join(t.split())
        assert r.nn == r.n  # idempotent


def test_path_times_monotone_and_endpoints(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(c), float(d), int(t0), int(t0 + dt))
            for a, b, c, d, t0, dt in zip(rng.uniform(-60, 60, 200), rng.uniform(-150, 150, 200),
                                          rng.uniform(-60, 60, 200), rng.uniform(-150, 150, 200),
                                          rng.integers(1.7e9, 1.71e9, 200),
                                          rng.integers(0, 50000, 200))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, t0 long, t1 long")
    for r in df.select("*", path_points("a", "b", "c", "d", "t0", "t1", 5).alias("p")).collect():
        ts = [p["t"] for p in r.p]
        assert ts == sorted(ts) and ts[0] == r.t0 and ts[-1] == r.t1
        assert (r.p[0]["lat"], r.p[-1]["lat"]) == (round(r.a, 5), round(r.c, 5))


def test_utc_hour_anchor(spark):
    from flightlake.operators.weather_risk import add_forecast_key
    df = spark.createDataFrame([(1709287200 + 5400, 1709287200)], "t long, leg_start long")
    leg = add_forecast_key(df, hour_anchor="leg_start").first()
    utc = add_forecast_key(df, hour_anchor="utc").first()
    assert leg["day0"] == 1709251200 and leg["fts"] == 1709251200 + 3600   # row 1 of the day
    assert utc["fts"] == 1709287200 + 3600                                 # the true hour


def test_last_wins_idempotent(spark):
    from flightlake.operators.dedup import last_wins
    df = spark.createDataFrame([("a", "x1", 1), ("a", "x2", 5), ("b", "y", 2), ("a", "x3", 3)],
                               "k string, v string, pos int")
    once = last_wins(df, ["k"], "v", F.col("pos"))
    assert {(r.k, r.v, r.first_seen) for r in once.collect()} == {("a", "x2", 1), ("b", "y", 2)}
    again = last_wins(once.withColumnRenamed("first_seen", "pos"), ["k"], "v", F.col("pos"))
    assert {(r.k, r.v) for r in again.collect()} == {("a", "x2"), ("b", "y")}


def test_trail_numbering_matches_brute_force_on_a_hot_flight(spark):
    """One flight with thousands of fixes over many hour buckets (plus ties)."""
    from flightlake.operators.sampling import sample_every_nth, trail_row_number

    rng = np.random.default_rng(5)
    rows = []
    for flight, n in (("hot", 6000), ("cold", 37)):
        times = rng.integers(1_709_251_200, 1_709_251_200 + 40 * 3600, n)
        for i, t in enumerate(times):
            rows.append((flight, int(i // 500), int(i % 500), int(t)))
    df = spark.createDataFrame(rows, "flight_id string, payload_seq long, pos int, time long")
    got = {(r.flight_id, r.payload_seq, r.pos): r.rn
           for r in trail_row_number(df).collect()}
    for flight in ("hot", "cold"):
        mine = sorted((r for r in rows if r[0] == flight), key=lambda r: (-r[3], -r[1], r[2]))
        for expected, r in enumerate(mine):
            assert got[(r[0], r[1], r[2])] == expected
    sampled = sample_every_nth(df, 10)
    assert sampled.filter("flight_id = 'hot'").count() == 600
    assert sampled.filter("flight_id = 'cold'").count() == 4


def test_normalize_strings_recurses_through_nested_types(spark):
    from flightlake.functions.text import normalize_strings
    schema = ("id int, s string, st struct<a: string, n: int, inner: struct<b: string>>, "
              "arr array<struct<c: string>>, tags array<string>, m map<string, string>")
    row = (1, "  x\t y ", (" a  b", 3, (" c ",)), [(" d  e",), None], [" f ", None],
           {"k": "  v  w"})
    df = spark.createDataFrame([row, (2, None, None, None, None, None)], schema)
    got = {r.id: r for r in normalize_strings(df).collect()}
    r = got[1]
    assert r.s == "x y" and r.st.a == "a b" and r.st.n == 3 and r.st.inner.b == "c"
    assert r.arr[0].c == "d e" and r.arr[1] is None
    assert r.tags == ["f", None] and r.m == {"k": "v w"}
    assert got[2].st is None and got[2].arr is None  # null structs stay null


def test_iso_to_epoch_edge_cases(spark):
    from datetime import datetime, timezone

    from flightlake.functions.timefn import epoch_to_text, iso_to_epoch
    texts = ["2024-03-01T10:00:00.999999+00:00", "2024-03-01", "2024-03-01T10:00:00-04:00",
             "2024-03-01 23:59:59", "1969-12-31T23:59:59.5+00:00", "2024-02-30T00:00:00", "",
             "2024-03-01T10:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.e for r in df.select(iso_to_epoch("s").alias("e")).collect()]

    def ref(t):  # whole seconds since the epoch, fraction dropped; naive text is UTC
        try:
            d = datetime.fromisoformat(t)
        except ValueError:
            return None
        if d.tzinfo is None:
            d = d.replace(tzinfo=timezone.utc)
        return int(d.timestamp())

    assert got[:5] == [ref(t) for t in texts[:5]]
    assert got[4] == 0           # truncated toward zero, also before 1970
    assert got[5] is None and got[6] is None   # impossible date, empty text
    assert got[7] == 1709287200  # a trailing Z is read as UTC
    shown = df.select(epoch_to_text(F.lit(1709287200), tz="Asia/Kolkata").alias("x")).first().x
    assert shown == "2024-03-01 15:30:00"
