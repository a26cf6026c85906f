import numpy as np

from flightlake.llm import ann


def distance(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):  # in order, without compensation
        total += (a - b) * (a - b)
    return float(np.sqrt(total))


def brute(rows, queries, k):
    out = {}
    for qid, q in queries:
        d = [(distance(q, v), i) for i, v in rows if i != qid and len(v) == len(q)]
        out[qid] = sorted(d)[:k]
    return out


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def run(spark, rows, k=10, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score double, width int")
    got = ann.block_matrix_join(df.where("vec_id % 100 = 0"), df, k=k, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_exact_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(16) * 10.0 ** rng.integers(-3, 4)]) for i in range(900)]
    rows += [(1000 + i, rows[100][1]) for i in range(15)]  # ties with query 100
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15),
             (2005, [float("inf")] * 16), (2100, [1.0, 2.0]), (2101, [1.0, 3.0])]
    good = [(i, v) for i, v in rows if usable(v)]
    want = brute(good, [(i, v) for i, v in good if i % 100 == 0], 10)
    full = [(i, v, 1, 0.5, 3) for i, v in rows] + [(None, [1.0] * 16, None, None, None)]
    for options in ({}, {"query_group": 3, "candidate_group": 100}):
        got = run(spark, full, **options)
        assert got == want
    assert [i for _, i in want[100]] == list(range(1000, 1010))
    assert len(want[2100]) == 1


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal((50, 33)) * 100, rng.standard_normal((60, 33))
    cx, sx, nx, ex = ann.quantise(x)
    cy, sy, ny, ey = ann.quantise(y)
    assert cx.dtype == np.int8
    near = np.sqrt(nx[:, None] ** 2 + ny[None] ** 2 - 2 * sx[:, None] * sy[None] * ann.int8_products(cx, cy))
    true = np.linalg.norm(x[:, None] - y[None], axis=2)
    assert (np.abs(near - true) <= ex[:, None] + ey[None] + 1e-9).all()
