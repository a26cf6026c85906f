import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from flightlake.llm import quality_rules as q
from tests.llm.data import awkward_rows, frame, words


def statistics(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
            "n_upper": len(re.findall("[A-Z]", text or ""))}


def brute(rows, min_rows):
    stats = [statistics(r[1]) for r in rows]
    failed = [s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"] for s in stats]
    floors = np.array(list(q.FLOORS.values())) * q.UNIT
    x = [None if f else tuple(math.floor(v * q.UNIT + 0.5) for v in (
        math.log(s["n_words"]), math.log(s["word_chars"] / s["n_words"]), math.log1p(100 * s["n_symbols"] / s["n_words"]),
        math.log1p(100 * s["n_dup_lines"] / s["n_lines"]), math.log1p(100 * s["n_repeat_words"] / s["n_words"]),
        math.log1p(100 * s["n_upper"] / s["word_chars"]))) for s, f in zip(stats, failed, strict=True)]
    pairs = defaultdict(set)
    for r, v in zip(rows, x, strict=True):
        if v:
            pairs[r[2], r[3]].add(v)
    by_lang = defaultdict(int)
    for (lang, _), vs in pairs.items():
        if len(vs) < min_rows:
            by_lang[lang] += len(vs)
    rest = sum(n for n in by_lang.values() if n < min_rows)
    pool = {}
    for (lang, source), vs in pairs.items():
        pool[lang, source] = (1, lang, source) if len(vs) >= min_rows else (2, lang) if by_lang[lang] >= min_rows else \
            3 if rest >= min_rows else None
    members = defaultdict(set)
    for k, vs in pairs.items():
        members[pool[k]] |= vs
    cut, factor, models = q.chi_square_point(q.TAIL, 6), q.consistency(q.SUPPORT, 6), {}
    for name, vs in members.items():
        if name is None:
            continue
        v = np.array(sorted(vs), float)
        centre = np.median(v, axis=0)
        cov = np.diag((1.4826 * np.median(np.abs(v - centre), axis=0)) ** 2 + floors ** 2)
        for _ in range(q.STEPS):
            d = np.einsum("ij,ij->i", v - centre, np.linalg.solve(cov, (v - centre).T).T)
            bins = np.floor(np.log(d + 1e-6) * q.BINS)
            below = np.array([(bins < b).sum() for b in bins])
            near = v[below < q.SUPPORT * len(v)]
            centre = near.mean(axis=0)
            cov = factor * ((near.T @ near) / len(near) - np.outer(centre, centre)) + np.diag(floors ** 2)
        models[name] = centre, cov
    out = []
    for r, s, f, v in zip(rows, stats, failed, x, strict=True):
        d = None
        if not f and pool[r[2], r[3]] is not None:
            centre, cov = models[pool[r[2], r[3]]]
            d = float((np.array(v) - centre) @ np.linalg.solve(cov, np.array(v) - centre))
        out.append((r[0], *(s[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), f,
                    None if d is None else round(d, 4), not f and (d is None or d <= cut)))
    return out


KEY = lambda x: tuple((v is None, v) for v in x)


@pytest.mark.parametrize("min_rows", [20, 10_000])
def test_statistics_and_verdicts(spark, min_rows):
    rows = awkward_rows(n=260)
    rows += [(500 + i, " ".join(f"{w}###" for w in r[1].split()), *r[2:]) for i, r in enumerate(rows[:12])]
    got = q.robust_outliers(frame(spark, rows, extra=True).repartition(3), min_rows=min_rows).collect()
    got = sorted(((*r[:7], None if r.distance is None else round(r.distance, 4), r.kept) for r in got), key=KEY)
    want = sorted(brute(rows, min_rows), key=KEY)
    assert [g[:7] for g in got] == [w[:7] for w in want] and [g[8] for g in got] == [w[8] for w in want]
    for g, w in zip(got, want, strict=True):
        assert (g[7] is None) == (w[7] is None) and (g[7] is None or g[7] == pytest.approx(w[7], rel=1e-6, abs=1e-3))
    if min_rows == 20:
        rejected = {g[0] for g in got if not g[6] and not g[8]}
        assert rejected and rejected >= {500 + i for i in range(12) if not brute(rows[-12:], 1)[i][6]}


def test_empty_table(spark):
    assert q.robust_outliers(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = q.robust_outliers(frame(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_chi_square():
    assert q.chi_square_tail(12.591587, 6) == pytest.approx(0.05, abs=1e-6)
    assert q.chi_square_point(0.05, 6) == pytest.approx(12.591587, abs=1e-5)
    assert q.consistency(0.999999, 6) == pytest.approx(1, abs=1e-3)
