"""History windows by blocks against a count over every hour."""

import math
import random

import pytest

from flightlake.operators.weather_risk import percentile_scores, risk_from_scores, trailing_history_counts

DAY, HOUR = 86400, 3600
SCORED = "cell long, day0 long, fts long, s_a double, s_b double"
OBSERVED = "cell long, ts_hour long, a double, b double"


def _value(rng):
    return rng.choice([None, math.nan, float(rng.randrange(6)), rng.random(), -math.inf, math.inf, 0.0, -0.0])


def _tables(seed, past_days):
    rng = random.Random(seed)
    hours = sorted({(rng.randrange(3), rng.randrange(-40, 120) * DAY + rng.randrange(24) * HOUR) for _ in range(1500)})
    observed = [(c, t, _value(rng), _value(rng)) for c, t in hours]
    keys = sorted({(rng.randrange(4), rng.randrange(-30, 130) * DAY, rng.randrange(5)) for _ in range(120)})
    scored = [(c, d, d + h * HOUR, _value(rng), _value(rng)) for c, d, h in keys]
    return scored, observed


def _brute(scored, observed, past_days, invert):
    out = {}
    for cell, day0, fts, *scores in scored:
        hours = [r for r in observed if r[0] == cell and day0 - past_days * DAY <= r[1] < day0 + DAY]
        row = [len(hours)]
        for i, (m, s) in enumerate(zip("ab", scores)):
            good = [r[2 + i] for r in hours if r[2 + i] is not None and not math.isnan(r[2 + i])]
            if s is None:
                lt = le = 0
            elif math.isnan(s):  # above every number
                lt = le = 0 if m in invert else len(good)
            elif m in invert:
                lt, le = sum(v > s for v in good), sum(v >= s for v in good)
            else:
                lt, le = sum(v < s for v in good), sum(v <= s for v in good)
            row += [len(hours) - len(good), lt, le]
        out[cell, day0, fts] = row
    return out


@pytest.mark.parametrize("past_days, invert", [(90, ()), (6, ("b",)), (0, ("a", "b"))])
def test_counts(spark, past_days, invert):
    scored, observed = _tables(past_days, past_days)
    got = trailing_history_counts(spark.createDataFrame(scored, SCORED), spark.createDataFrame(observed, OBSERVED),
                                  past_days, ("a", "b"), invert).collect()
    found = {(r.cell, r.day0, r.fts): [r.n_hist, r.bad_a, r.lt_a, r.le_a, r.bad_b, r.lt_b, r.le_b] for r in got}
    assert len(got) == len(scored)
    assert found == _brute(scored, observed, past_days, invert)


def test_no_history_and_no_keys(spark):
    keys = spark.createDataFrame([(1, 0, 0, 1.0, None)], SCORED)
    none = spark.createDataFrame([], OBSERVED)
    row = risk_from_scores(percentile_scores(trailing_history_counts(keys, none, 90, ("a", "b")), ("a", "b")), ("a", "b")).first()
    assert (row.n_hist, row.s_a, row.risk) == (0, 1.0, -1.0)
    some = spark.createDataFrame([(1, 0, 1.0, 2.0)], OBSERVED)
    assert trailing_history_counts(spark.createDataFrame([], SCORED), some, 90, ("a", "b")).count() == 0
