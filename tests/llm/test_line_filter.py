import random

import numpy as np
import pytest

from flightlake.llm import line_filter
from tests.llm.data import awkward_rows, frame

SPACE = "\x20\t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, least_chars=20, least_docs=3, keep="last"):
    holders = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            holders.setdefault(key(line), set()).add(r[0])
    order = lambda d: (d is not None, d or 0)
    stays = {k: (max if keep == "last" else min)(d, key=order) for k, d in holders.items()
             if len(k) >= least_chars and len(d) >= least_docs}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if key(x) not in stays or stays[key(x)] == r[0]]
        out.append((r[0], len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    got = line_filter.remove_common_lines(frame(spark, rows, extra=True).repartition(3), **options)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def boilerplate(seed=3, n=90):
    rng = random.Random(seed)
    stock = [f"Shared line number {k} of the site " + "é" * (k % 5) for k in range(25)]
    stock += ["short line", "nineteen characters", "twenty characters ok", "中文字符" * 5, "中文字符" * 4 + "中文字", ""]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(0, 12)):
            line = rng.choice(stock) if rng.random() < 0.6 else f"line of its own {i} {rng.random()}"
            line = line.upper() if rng.random() < 0.2 else line
            lines.append(rng.choice(["", " ", "\t", " "]) + line + rng.choice(["", "\r", "  "]))
        rows.append((i if rng.random() < 0.95 else None, "\n".join(lines), "en", "a", 1))
    return rows + [(5, rows[5][1], "en", "a", 1), (5, "\n".join(stock), "en", "b", 1)]


@pytest.mark.parametrize("keep", ["last", "first"])
def test_boilerplate(spark, keep):
    rows = boilerplate()
    got = run(spark, rows, keep=keep, shard_bytes=500)
    assert got == brute(rows, keep=keep)
    assert sum(r[2] for r in got) > 100


def test_twice_is_enough_when_asked(spark):
    rows = boilerplate(4, 40)
    assert run(spark, rows, least_docs=2, least_chars=5) == brute(rows, 5, 2)


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert run(spark, rows) == brute(rows)


def test_a_line_of_all_documents(spark):
    rows = [(i, f"This line is in every document\nand this one {i} is not, anywhere", "en", "a", 1) for i in range(5000)]
    got = run(spark, rows)
    assert [r for r in got if r[2] == 0] == [(4999, 2, 0, rows[4999][1])]
    assert sum(r[2] for r in got) == 4999


def test_empty_table(spark):
    assert run(spark, []) == []


def test_refuses_what_it_cannot_do(spark):
    with pytest.raises(ValueError):
        line_filter.remove_common_lines(frame(spark, []), least_docs=1)


def test_filters_miss_no_repeat():
    rng = np.random.default_rng(5)
    some = rng.integers(0, 1 << 32, 300_000, dtype=np.uint64).astype(np.uint32)
    hashes = np.concatenate([some, some[:1000]])
    rng.shuffle(hashes)
    found = line_filter.twice_seen(hashes, np.zeros(len(hashes), bool))
    _, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
    assert found[count[back] > 1].all()
    assert found[count[back] == 1].mean() < 0.01
    assert line_filter.twice_seen(some[:3], np.array([False, True, False])).tolist() == [False, True, False]
