"""Weather risk per waypoint: forecast lookup (J3), trailing-window history join
(J4), percentile-of-score (A1) and the max-of-metrics risk (A2).

Scale design
------------
* Waypoints are reduced to distinct keys ``(cell, day0, fts)`` first: the
  history work depends on the number of distinct places and hours, not on the
  number of flights.  The distinct is a partial + final hash aggregate, so a
  hub cell holding a third of all waypoints collapses map-side.
* The trailing window is an *equi* join by blocks: history is shuffled once, to
  one row per cell and block of ``past_days + 1`` days with its values sorted, and
  a window touches two blocks at most.  Keys of one ``(cell, day0)`` travel as a row.
* Ranks are binary searches in the sorted values; no row per key and hour is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.geo import round_half_even
from flightlake.functions.risk import MISSING_SCORE, percentile_of_score
from flightlake.functions.search import count_at_or_below, count_below
from flightlake.functions.timefn import SECONDS_PER_DAY, SECONDS_PER_HOUR, day_start, hour_offset
from flightlake.operators.places import bound_to_places
from flightlake.schemas import SCORED_METRICS
from flightlake.session import materialize

KEY = ["cell", "day0", "fts"]
# Risk tables up to this many keys are broadcast to the waypoints (a key row is
# four 8-byte values); beyond it the join back is salted.
DEFAULT_MAX_BROADCAST_KEYS = 1_000_000
DEFAULT_SALT_BUCKETS = 32
# A key of more waypoints than this is spread over the salt buckets (the number of
# such keys is at most the waypoints divided by it).
HOT_KEY_POINTS = 100_000
# Optional partition column of weather tables: UTC day number of ``ts_hour``.
DAY_COLUMN = "day"
# Column of forecast tables that hold several issues of an hour (seconds since 1970).
ISSUE_COLUMN = "issue"


def add_forecast_key(points: DataFrame, t: str = "t", leg_start: str = "leg_start",
                     hour_anchor: str = "leg_start") -> DataFrame:
    """Add ``day0`` (00:00 UTC of the leg start day) and ``fts`` (forecast hour).

    ``hour_anchor='leg_start'``: the hour index counted from the leg start is
    used as a row number into the series that begins at ``day0`` (parity with
    the original planner).  ``'utc'``: the true hour of the waypoint time.
    """
    day0 = day_start(F.col(leg_start))
    if hour_anchor == "leg_start":
        fts = day0 + (hour_offset(F.col(t), F.col(leg_start)) - 1) * F.lit(SECONDS_PER_HOUR)
    elif hour_anchor == "utc":
        fts = F.col(t) - F.pmod(F.col(t), F.lit(SECONDS_PER_HOUR))
    else:
        raise ValueError(f"unknown hour_anchor {hour_anchor!r}")
    return points.withColumns({"day0": day0, "fts": fts})


def forecast_lookup(keys: DataFrame, forecast: DataFrame, metrics: Sequence[str] = SCORED_METRICS,
                    as_of: Column | int | None = None) -> DataFrame:
    """Left equi join key -> forecast row at ``(cell, fts)``; adds ``s_<metric>``.

    A key without a forecast row keeps null scores (scored as missing later).  A table
    with an ``issue`` column holds every issue of an hour: the newest one not after
    ``as_of`` counts (seconds; a column of ``keys``, or one number for all; None: the newest).
    """
    if ISSUE_COLUMN in forecast.columns:
        return _forecast_as_of(keys, forecast, metrics, as_of)
    fc = forecast.select(F.col("cell"), F.col("ts_hour").alias("fts"),
                         *[F.col(m).alias(f"s_{m}") for m in metrics])
    return keys.join(fc, ["cell", "fts"], "left")


def _forecast_as_of(keys: DataFrame, forecast: DataFrame, metrics: Sequence[str], as_of: Column | int | None) -> DataFrame:
    """As-of join on the issue: the issues of an hour are an array in order, and a key searches its own.

    An array holds the issues of one place and hour (as many as forecasts reach it).
    """
    if as_of is not None and not isinstance(as_of, Column):
        forecast = forecast.where(F.col(ISSUE_COLUMN) <= F.lit(as_of))  # reaches the scan
    values = F.struct(*[F.col(m).alias(f"s_{m}") for m in metrics])
    # an issue that was pulled twice: the newer pull counts
    order = [ISSUE_COLUMN, *(c for c in ("pull",) if c in forecast.columns)]
    if isinstance(as_of, Column):
        issued = F.array_sort(F.collect_list(F.struct(*order, values.alias("_values"))))
        fc = (forecast.groupBy("cell", F.col("ts_hour").alias("fts")).agg(issued.alias("_issued"))
              .withColumn("_when", F.col(f"_issued.{ISSUE_COLUMN}")))
        met = keys.withColumn("_as_of", as_of).join(fc, ["cell", "fts"], "left")
        found = F.get("_issued", count_at_or_below(F.col("_when"), F.col("_as_of")) - 1)["_values"]
    else:
        fc = forecast.groupBy("cell", F.col("ts_hour").alias("fts")).agg(F.max_by(values, F.struct(*order)).alias("_values"))
        met, found = keys.join(fc, ["cell", "fts"], "left"), F.col("_values")
    return (met.withColumn("_found", found).select(*keys.columns, *[F.col(f"_found.s_{m}").alias(f"s_{m}") for m in metrics]))


def trailing_history_counts(scored: DataFrame, observed: DataFrame, past_days: int = 90,
                            metrics: Sequence[str] = SCORED_METRICS,
                            invert: Sequence[str] = ()) -> DataFrame:
    """Per key: history size and, per metric, counts below / at-or-below the score.

    History window: every observed hour of the ``past_days`` days before the
    leg start day and of the start day itself.  Metrics in ``invert`` rank
    the other way round (a lower value is riskier): their counts are of
    history values above / at-or-above the score.
    Output: ``cell, day0, fts, n_hist, s_m, bad_m, lt_m, le_m`` for each metric.

    A block of history is as long as a window, so a window lies in two blocks at
    most: the keys of a ``(cell, day0)`` meet these two, take the days that they
    share and search the sorted values.  What travels behind the join are counts.
    """
    days = past_days + 1
    blocks = history_blocks(observed, days, metrics)
    s_cols = [f"s_{m}" for m in metrics]
    last = (F.col("day0") / F.lit(SECONDS_PER_DAY)).cast("long")
    # one row per (cell, day0) with its forecast hours: few, however many flights there are
    starts = (scored.groupBy("cell", "day0").agg(F.collect_list(F.struct("fts", *s_cols)).alias("_keys"))
              .withColumns({"_last": last, "_first": last - F.lit(past_days)})
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("_first") / days), F.floor(F.col("_last") / days)))))
    inside = lambda day: (day >= F.col("_first")) & (day <= F.col("_last"))
    shared = {f"_v_{m}": F.transform(F.filter(f"_sorted_{m}", lambda x: inside(x["hday"])), lambda x: x["v"]) for m in metrics}
    met = (starts.join(blocks, ["cell", "block"], "left")
           .withColumns(shared | {"_n": F.size(F.filter("_days", inside))})
           .select("cell", "day0", "_n", *shared, F.explode("_keys").alias("_key")))
    # the arrays are columns by now (see ``explode``): a search reads them in place
    counts = {}
    for m in metrics:
        values, score = F.col(f"_v_{m}"), F.col(f"_key.s_{m}")
        n = F.coalesce(F.size(values), F.lit(0))
        lt, le = count_below(values, score), count_at_or_below(values, score)
        if m in invert:
            lt, le = n - le, n - lt
        counts[f"bad_{m}"] = F.coalesce(F.col("_n"), F.lit(0)) - n
        counts[f"lt_{m}"] = F.when(score.isNotNull(), lt).otherwise(F.lit(0))
        counts[f"le_{m}"] = F.when(score.isNotNull(), le).otherwise(F.lit(0))
    halves = met.select("cell", "day0", F.col("_key.fts").alias("fts"), F.coalesce("_n", F.lit(0)).alias("n_hist"),
                        *[F.col(f"_key.{c}").alias(c) for c in s_cols], *[c.alias(name) for name, c in counts.items()])
    aggs = [F.sum("n_hist").alias("n_hist")]
    for m in metrics:
        aggs += [F.max(f"s_{m}").alias(f"s_{m}"), *[F.sum(f"{c}_{m}").alias(f"{c}_{m}") for c in ("bad", "lt", "le")]]
    return halves.groupBy(*KEY).agg(*aggs)


def history_blocks(observed: DataFrame, days: int, metrics: Sequence[str] = SCORED_METRICS) -> DataFrame:
    """``cell, block, _days, _sorted_<metric>``: history by blocks of ``days`` days.

    ``_days`` has the day of every hour; ``_sorted_m`` the hours with a value, as
    ``(v, hday)`` in the order of the values (NaN and null have none).  Observed tables
    hold one row per ``(cell, ts_hour)`` (see ``sources.weather.latest_pull``): an array
    has at most ``days * 24`` entries.  The one shuffle of the history is this one.
    """
    # A landed weather table carries its UTC day number; otherwise derive it.
    day = F.col(DAY_COLUMN) if DAY_COLUMN in observed.columns \
        else F.floor(F.col("ts_hour") / F.lit(SECONDS_PER_DAY))
    hours = observed.select("cell", day.cast("long").alias("hday"), *metrics)
    hours = hours.withColumn("block", F.floor(F.col("hday") / F.lit(days)))

    def ordered(m: str):
        value = F.struct(F.col(m).cast("double").alias("v"), "hday")
        return F.sort_array(F.collect_list(F.when(F.col(m).isNotNull() & ~F.isnan(m), value))).alias(f"_sorted_{m}")

    return hours.groupBy("cell", "block").agg(F.collect_list("hday").alias("_days"), *[ordered(m) for m in metrics])


def percentile_scores(counts: DataFrame, metrics: Sequence[str] = SCORED_METRICS,
                      nan_policy: str = "propagate") -> DataFrame:
    """Per key and metric: percentile of the forecast score in its history.

    Missing (score null/NaN, empty history, or a NaN in history under
    ``nan_policy='propagate'``) scores ``-1``.  Adds ``pct_<metric>``.
    """
    if nan_policy not in ("propagate", "omit"):
        raise ValueError(f"unknown nan_policy {nan_policy!r}")
    out = {}
    for m in metrics:
        s, bad = F.col(f"s_{m}"), F.col(f"bad_{m}")
        n = F.col("n_hist") if nan_policy == "propagate" else F.col("n_hist") - bad
        pct = percentile_of_score(F.col(f"lt_{m}"), F.col(f"le_{m}"), n)
        missing = s.isNull() | F.isnan(s)
        if nan_policy == "propagate":
            missing = missing | (bad > 0)
        out[f"pct_{m}"] = F.when(missing, F.lit(MISSING_SCORE)).otherwise(
            F.coalesce(pct, F.lit(MISSING_SCORE)))
    return counts.withColumns(out)


def risk_from_scores(scores: DataFrame, metrics: Sequence[str] = SCORED_METRICS) -> DataFrame:
    """Risk = max over metric percentiles, rounded half-even to one decimal."""
    worst = F.greatest(*[F.col(f"pct_{m}") for m in metrics]) if len(metrics) > 1 \
        else F.col(f"pct_{metrics[0]}")
    return scores.withColumn("risk", round_half_even(worst, 1))


def key_stats(keys: DataFrame):
    """One small aggregate over the distinct keys: their count and time range.

    The count is an exact bound on the risk table (one row per key); the range
    bounds the weather scans.
    """
    return keys.agg(F.count(F.lit(1)).alias("n"), F.min("day0").alias("lo"),
                    F.max("day0").alias("hi"), F.min("fts").alias("flo"),
                    F.max("fts").alias("fhi")).first()


def weather_window(observed: DataFrame, forecast: DataFrame, stats,
                   past_days: int) -> tuple[DataFrame, DataFrame]:
    """Restrict both weather tables to the hours the keys (``stats``) can use.

    The literal range predicates on ``ts_hour`` reach the parquet scan
    (row-group skipping), and on ``day`` they prune partitions of tables
    partitioned by day, so a multi-year table is read only for needed months.
    """
    if stats is None or stats["lo"] is None:
        return observed, forecast
    h_lo = stats["lo"] - past_days * SECONDS_PER_DAY
    h_hi = stats["hi"] + SECONDS_PER_DAY

    def bound(df: DataFrame, lo: int, hi_incl: int) -> DataFrame:
        out = df.filter((F.col("ts_hour") >= F.lit(lo)) & (F.col("ts_hour") <= F.lit(hi_incl)))
        if DAY_COLUMN in df.columns:
            # Tables partitioned by day number: the same bound prunes partitions.
            out = out.filter((F.col(DAY_COLUMN) >= F.lit(lo // SECONDS_PER_DAY))
                             & (F.col(DAY_COLUMN) <= F.lit(hi_incl // SECONDS_PER_DAY)))
        return out

    return bound(observed, h_lo, h_hi - 1), bound(forecast, stats["flo"], stats["fhi"])


def key_risk(keys: DataFrame, observed: DataFrame, forecast: DataFrame, past_days: int = 90,
             metrics: Sequence[str] = SCORED_METRICS, nan_policy: str = "propagate",
             prune_weather: bool = False, invert: Sequence[str] = (), as_of: int | None = None) -> DataFrame:
    """Risk table for distinct keys ``(cell, day0, fts)``.

    ``prune_weather`` bounds both weather scans to the keys' time range first
    (one small aggregate job); worth it whenever the weather table spans more
    time than the planned flights need.
    """
    if prune_weather:
        observed, forecast = weather_window(observed, forecast, key_stats(keys), past_days)
    scored = forecast_lookup(keys, forecast, metrics, as_of)
    counts = trailing_history_counts(scored, observed, past_days, metrics, invert)
    return risk_from_scores(percentile_scores(counts, metrics, nan_policy), metrics)


def score_waypoints(points: DataFrame, observed: DataFrame, forecast: DataFrame,
                    past_days: int = 90, hour_anchor: str = "leg_start",
                    metrics: Sequence[str] = SCORED_METRICS,
                    nan_policy: str = "propagate", prune_weather: bool = True,
                    max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
                    salt_buckets: int = DEFAULT_SALT_BUCKETS, hot_key_points: int = HOT_KEY_POINTS,
                    invert: Sequence[str] = (), materialize_keys: bool = True, as_of: int | None = None) -> DataFrame:
    """Attach ``risk`` to every waypoint row.

    ``points`` needs ``cell``, ``t`` and ``leg_start``; ``observed`` and
    ``forecast`` need ``cell``, ``ts_hour`` (epoch of the hour) and the metrics; of a forecast
    with issues the newest one not after ``as_of`` counts.

    Join back: the exact key count (one small aggregate, shared with the
    weather bounds) proves the risk table's size.  Up to ``max_broadcast_keys``
    it is broadcast and the waypoints are not shuffled at all; above it the
    join shuffles, and keys of more than ``hot_key_points`` waypoints are spread
    over ``salt_buckets`` tasks instead of one.
    """
    pts = add_forecast_key(points, hour_anchor=hour_anchor)
    keys = pts.select(*KEY).distinct()
    if materialize_keys:
        # Counted once and scored once: write the (few) keys instead of
        # scanning every waypoint twice.
        keys = materialize(keys, "risk-keys")
    stats = key_stats(keys)
    if prune_weather:
        observed, forecast = weather_window(observed, forecast, stats, past_days)
        if materialize_keys:
            # the keys are few and written: their places are cheap to find, and row groups of others are skipped
            observed, forecast = bound_to_places(observed, keys), bound_to_places(forecast, keys)
    risk = key_risk(keys, observed, forecast, past_days, metrics, nan_policy,
                    prune_weather=False, invert=invert, as_of=as_of).select(*KEY, "risk")
    if stats["n"] <= max_broadcast_keys:
        joined = pts.join(F.broadcast(risk), KEY, "left")
    else:
        # Only keys of many waypoints are replicated; their waypoints are spread over the buckets.
        hot = pts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_key_points)
        hot = materialize(hot.select(*KEY, F.lit(True).alias("_hot")), "hot-keys")
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in pts.columns]), F.lit(salt_buckets)).cast("int")
        last = F.when(F.col("_hot"), F.lit(salt_buckets - 1)).otherwise(F.lit(0))
        spread_risk = (risk.join(hot, KEY, "left")
                       .withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_hot"))
        joined = (pts.join(hot, KEY, "left")
                  .withColumn("_salt", F.when(F.col("_hot"), bucket).otherwise(F.lit(0))).drop("_hot")
                  .join(spread_risk, [*KEY, "_salt"], "left").drop("_salt"))
    return joined.withColumn("risk", F.coalesce(F.col("risk"), F.lit(MISSING_SCORE)))
