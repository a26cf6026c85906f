import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import periodic_runs
from flightlake.llm.queries import op12_recompression_runs
from tests.llm.data import awkward_rows, frame, sentence, words


def brute_runs(w, least=24, periods=3):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, periods * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(text, least=24):
    w = words(text)
    runs = brute_runs(w, least)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(w), len(runs), *best, 1000 * best[1] // best[2] if runs else None, listed,
            " ".join(x for i, x in enumerate(w) if i not in gone))


def looped(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return text
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return " ".join(w[a + (i - a) % p] if i >= a else w[i] for i in range(len(w)))


def periodic_text(rng):
    w = []
    for _ in range(rng.randrange(1, 8)):
        stock = rng.choice([1, 2, 3, 50])
        part = [f"w{rng.randrange(stock)}" for _ in range(rng.randrange(1, 20))]
        part = part * 3 + ["end"] if rng.random() < 0.3 else part
        w += part * rng.randrange(1, 9)
    return rng.choice([" ", "\n", "\t  "]).join(w)


def run(spark, rows, **options):
    got = periodic_runs.periodic_runs(frame(spark, rows, extra=True).repartition(3), **options).collect()
    for r in got:
        assert r.runs_sha256 == sha256(r.runs.encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(r.collapsed.encode()).hexdigest()
    return sorted((tuple(r)[:9] for r in got), key=str)


def test_periodic_texts(spark):
    rng = random.Random(6)
    rows = [(i, periodic_text(rng), "en", "a", 1) for i in range(200)]
    want = sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert sum(r[2] for r in want) > 500
    assert run(spark, rows) == want
    small = sorted(((r[0], *brute(r[1], 5)) for r in rows[:60]), key=str)
    assert run(spark, rows[:60], least_words=5) == small


def test_awkward_rows(spark):
    rows = [r for r in awkward_rows() if r[0] != 111] + [(200, "a b " * 2000 + "c " * 3000, "en", "a", 1)]
    assert run(spark, rows) == sorted(((r[0], *brute(r[1])) for r in rows), key=str)


def test_a_long_text(spark):
    rng = random.Random(2)
    part = sentence(rng, 5000)
    text = sentence(rng, 30000) + " " + " ".join([part] * 4) + " x" * 40000
    (row,) = run(spark, [(1, text, "en", "a", 1)])
    assert row[2] == 2
    assert (row[4], row[5], row[6]) == (40000, 1, 40_000_000)
    assert any(int(x.split(",")[2]) == 5000 for x in row[7].split())


def test_empty_table_and_options(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(frame(spark, []), periods=2)


def test_blocks_do_not_matter(spark, monkeypatch):
    rng = random.Random(9)
    texts = [periodic_text(rng).encode().split() for _ in range(40)]
    whole = periodic_runs._block(list(range(40)), texts, 24, 3).to_pylist()
    single = [periodic_runs._block([i], [t], 24, 3).to_pylist()[0] for i, t in enumerate(texts)]
    assert whole == single


def test_looped_tails(spark):
    rows = awkward_rows()
    got = frame(spark, rows).select("doc_id", F.col("text").alias("was"), periodic_runs.looped_tail().alias("text")).collect()
    assert [r.text for r in got] == [looped(r.doc_id, r.was) for r in got]
    assert sum(r.text != r.was for r in got) > 3


def test_query(spark, tmp_path):
    rows = awkward_rows()
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op12_recompression_runs(spark, str(tmp_path)).collect()), key=str)
    want = []
    for r in rows:
        n, runs, start, length, period, milli, listed, text = brute(looped(r[0], r[1])) if r[0] != 111 else [None] * 8
        if r[0] != 111:
            want.append((r[0], runs, start, length, period, milli, sha256(listed.encode()).hexdigest(),
                         sha256(text.encode()).hexdigest()))
    assert [r for r in got if r[0] != 111] == sorted(want, key=str)


def test_extents_of_all_pairs():
    rng = np.random.default_rng(4)
    for stock in (1, 2, 3, 40):
        s = np.append(rng.integers(0, stock, 60), 99)
        s[20:50] = np.tile(s[20:25], 6)
        x, y = (v.ravel() for v in np.meshgrid(np.arange(60), np.arange(60)))
        x, y = x[x != y], y[x != y]
        grammar = periodic_runs.Grammar(s)
        for back in (False, True):
            got = grammar.extent(x, y, back)
            for a, b, n in zip(x, y, got, strict=True):
                k = 0
                step = -k if back else k
                while 0 <= min(a, b) + step and max(a, b) + step < len(s) and s[a + step] == s[b + step]:
                    k += 1
                    step = -k if back else k
                assert n == k
