"""Quality rules with robust multivariate outliers (operator 10), DataFrame functions only.

Text statistics come from one projection per document.  Two fixed rules reject
short and repetitive texts.  The rest is judged by a minimum covariance
determinant (MCD) estimate per language and source: six transformed statistics,
concentration steps that keep the ``support`` share of the documents nearest to
the current centre, and a cut on the squared Mahalanobis distance.

* The transformed statistics are rounded to 1/256, so all sums are sums of whole
  numbers: exact, and the same for any partitioning and on every rerun.
* A concentration step is one aggregation: counts and moments per distance bin
  (64 bins per factor e), a running count per pool, and the moments of the bins
  that hold the nearest ``support`` share (whole bins, so at least that share).
  A pool that holds a third of all documents is summed before the shuffle.
* Equal statistic vectors of a pool count once in the fit: a large group of copies
  cannot pull the estimate onto itself.
* A pool is a (language, source) pair with at least ``min_rows`` different vectors;
  smaller pairs of one language form a pool together, and what is still smaller
  forms one last pool.  Where even that is too small there is no verdict.
* ``floors`` are the least standard deviations (a statistic may be constant).

Defined results: null texts have no words and fail the base rule; null languages
and sources are values of their own; repeated rows are judged alike, each with a
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import SEPARATOR_RUN, written

#: Resolution of the transformed statistics and of ln(squared distance).
UNIT = 256
BINS = 64
#: The transformed statistics, with their least standard deviations.
FLOORS = {"x_words": 0.3, "x_length": 0.05, "x_symbols": 0.3, "x_lines": 1.0, "x_repeats": 1.0, "x_upper": 0.3}
#: Share of a pool that the estimate rests on, concentration steps, and the chi-square tail beyond the cut.
SUPPORT = 0.75
STEPS = 6
TAIL = 1e-9
MIN_ROWS = 100
#: The fixed rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR_RUN), "")


def _covered(hashes: Column) -> Column:
    """Words inside 3-word windows whose hash occurs twice or more."""
    def spans(s: Column) -> Column:
        same = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, b: a + b))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
        let(ordered, spans))


def repeat_words(w: Column) -> Column:
    """Number of words of the array ``w`` in 3-word windows found twice or more."""
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(windows, _covered))


def text_statistics(text: Column) -> Column:
    """A struct of the statistics of one text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return let(of_words, lambda w: let(of_lines, lambda x: F.struct(
        w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"),
        F.char_length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        x["n_dup_lines"].alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
        x["n_lines"].alias("n_lines"),
        F.char_length(F.regexp_replace(t, r"[^A-Z]+", "")).cast("long").alias("n_upper"))))


def _share(part: str, whole: str) -> Column:
    return F.log1p(100.0 * F.col(part) / F.col(whole))


def transformed() -> dict[str, Column]:
    """The six statistics as whole multiples of 1/UNIT."""
    x = {"x_words": F.log(F.col("n_words").cast("double")), "x_length": F.log(F.col("word_chars") / F.col("n_words")),
         "x_symbols": _share("n_symbols", "n_words"), "x_lines": _share("n_dup_lines", "n_lines"),
         "x_repeats": _share("n_repeat_words", "n_words"), "x_upper": _share("n_upper", "word_chars")}
    return {k: F.round(v * UNIT).cast("long") for k, v in x.items()}


def chi_square_tail(x: float, degrees: int) -> float:
    """P(chi-square > x) for an even number of degrees of freedom."""
    term = total = math.exp(-x / 2)
    for j in range(1, degrees // 2):
        term *= x / 2 / j
        total += term
    return total


def chi_square_point(tail: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_tail(mid, degrees) > tail else (low, mid)
    return high


def consistency(support: float, p: int) -> float:
    """Factor that makes the covariance of the central ``support`` share that of all (normal data)."""
    return support / (1 - chi_square_tail(chi_square_point(1 - support, p), p + 2))


def _pools(rows: DataFrame, min_rows: int) -> DataFrame:
    """``(l, s) -> pool`` of every language and source; null where no estimate is possible."""
    pairs = rows.groupBy("l", "s").agg(F.count("*").alias("n"))
    by_lang = pairs.where(F.col("n") < min_rows).groupBy("l").agg(F.sum("n").alias("n_lang"))
    rest = (by_lang.where(F.col("n_lang") < min_rows).groupBy(F.lit(1).alias("one"))
            .agg(F.sum("n_lang").alias("n_rest")))
    return (pairs.join(by_lang, "l", "left").withColumn("one", F.lit(1)).join(rest, "one", "left")
            .select("l", "s", F.when(F.col("n") >= min_rows, F.concat(F.lit("1"), "l", F.lit("\x00"), "s"))
                    .when(F.col("n_lang") >= min_rows, F.concat(F.lit("2"), "l"))
                    .when(F.col("n_rest") >= min_rows, F.lit("3")).alias("pool")))


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance from the columns of a row and of its pool's model."""
    total = None
    for i in range(len(names)):
        z = None
        for j in range(i + 1):
            term = F.col(f"w_{i}_{j}") * (F.col(names[j]) - F.col(f"m_{j}"))
            z = term if z is None else z + term
        total = z * z if total is None else total + z * z
    return total


def _whitened(moments: DataFrame, floors: dict[str, float], factor: float) -> DataFrame:
    """Per pool: centre ``m_j`` and the inverse Cholesky factor ``w_i_j`` of the floored covariance."""
    names = list(floors)
    p = len(names)
    df = moments.select("pool", "k", *[(F.col(f"s_{j}") / F.col("k")).alias(f"m_{j}") for j in range(p)],
                        *[F.col(f"q_{i}_{j}") for i in range(p) for j in range(i + 1)])
    df = df.select("*", *[(factor * (F.col(f"q_{i}_{j}") / F.col("k") - F.col(f"m_{i}") * F.col(f"m_{j}"))
                           + (F.lit((floors[names[i]] * UNIT) ** 2) if i == j else F.lit(0.0))).alias(f"c_{i}_{j}")
                          for i in range(p) for j in range(i + 1)])
    for j in range(p):  # Cholesky, a column at a time
        def rest(i: int, j: int = j) -> Column:
            e = F.col(f"c_{i}_{j}")
            for k in range(j):
                e = e - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            return e
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(rest(j)))
        df = df.withColumns({f"l_{i}_{j}": rest(i) / F.col(f"l_{j}_{j}") for i in range(j + 1, p)})
    for i in range(p):  # its inverse, a row at a time
        row = {f"w_{i}_{i}": 1.0 / F.col(f"l_{i}_{i}")}
        for j in range(i):
            e = None
            for k in range(j, i):
                t = F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}")
                e = t if e is None else e + t
            row[f"w_{i}_{j}"] = -e / F.col(f"l_{i}_{i}")
        df = df.withColumns(row)
    return df.select("pool", *[f"m_{j}" for j in range(p)],
                     *[f"w_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _first_model(fit: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Medians and scaled median deviations: whole numbers, so both percentiles are exact."""
    names = list(floors)
    mid = fit.groupBy("pool").agg(*[F.percentile(x, 0.5).alias(f"m_{j}") for j, x in enumerate(names)])
    dev = (fit.join(mid, "pool").groupBy("pool")
           .agg(*[F.percentile(F.abs(F.col(x) - F.col(f"m_{j}")), 0.5).alias(f"d_{j}") for j, x in enumerate(names)]))
    one = [1.0 / F.sqrt(F.pow(1.4826 * F.col(f"d_{j}"), F.lit(2.0)) + (floors[x] * UNIT) ** 2)
           for j, x in enumerate(names)]
    return mid.join(dev, "pool").select(
        "pool", *[f"m_{j}" for j in range(len(names))],
        *[(one[i] if i == j else F.lit(0.0)).alias(f"w_{i}_{j}") for i in range(len(names)) for j in range(i + 1)])


def _concentrated(fit: DataFrame, model: DataFrame, floors: dict[str, float], support: float, factor: float) -> DataFrame:
    """One concentration step: the model of the documents nearest to the given model's centre."""
    names = list(floors)
    p = len(names)
    bins = F.floor(F.log(_distance(names) + 1e-6) * BINS)
    sums = [F.sum(x).alias(f"s_{j}") for j, x in enumerate(names)]
    sums += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"q_{i}_{j}") for i in range(p) for j in range(i + 1)]
    binned = fit.join(model, "pool").withColumn("bin", bins).groupBy("pool", "bin").agg(F.count("*").alias("k"), *sums)
    before = Window.partitionBy("pool").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    near = (binned.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0)))
            .withColumn("n", F.sum("k").over(Window.partitionBy("pool")))
            .where(F.col("before") < support * F.col("n")))
    cols = ["k"] + [f"s_{j}" for j in range(p)] + [f"q_{i}_{j}" for i in range(p) for j in range(i + 1)]
    return _whitened(near.groupBy("pool").agg(*[F.sum(c).alias(c) for c in cols]), floors, factor)


def robust_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source", floors: dict[str, float] | None = None, support: float = SUPPORT,
                    steps: int = STEPS, tail: float = TAIL, min_rows: int = MIN_ROWS) -> DataFrame:
    """Statistics, base rule, distance and verdict of every document.

    Returns ``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance, kept``; ``distance`` (squared) is null without an estimate.
    """
    floors = floors or FLOORS
    p = len(floors)
    key = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in (lang_col, source_col)]
    rows = (docs.select(F.col(id_col).alias("id"), key[0].alias("l"), key[1].alias("s"),
                        text_statistics(F.col(text_col)).alias("t")).select("id", "l", "s", "t.*"))
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    rows = written(rows.select("*", *[F.when(~F.col("base_failed"), v).alias(k) for k, v in transformed().items()]),
                   "quality-statistics")
    vectors = rows.where(~F.col("base_failed")).select("l", "s", *floors).distinct()
    vectors = written(vectors, "quality-vectors")
    pools = written(_pools(vectors, min_rows), "quality-pools")
    fit = written(vectors.join(pools, ["l", "s"]).where(F.col("pool").isNotNull()).select("pool", *floors).distinct(),
                  "quality-fit")
    model = written(_first_model(fit, floors), "quality-model")
    factor = consistency(support, p)
    for _ in range(steps):
        model = written(_concentrated(fit, model, floors, support, factor), "quality-model")
    judged = rows.join(pools, ["l", "s"], "left").join(model, "pool", "left")
    distance = F.when(~F.col("base_failed"), _distance(list(floors)))
    judged = judged.withColumn("distance", distance)
    cut = chi_square_point(tail, p)
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "distance",
                         (~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))).alias("kept"))
