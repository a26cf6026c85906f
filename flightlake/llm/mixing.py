"""Mixing sources to target weights by pivotal dependent rounding (operator 3).

Every unit (one row) starts with the same fractional number of
copies ``target / source_size``.  The whole part is taken; the fractions are
rounded by the pivotal method in its size-weighted form: two units of a source
meet, words move from one to the other until one fraction becomes 0 or 1, with
chances that keep each unit's expected copies.  The words taken from a source stay
equal to its target but for the single fraction that is left at the very end. What
rounding it misses is dealt to the buckets, where smaller units make up for it (``land``).

The meetings form a tree.  Units are dealt into buckets of about ``bucket_units``
by a hash of their id (a source with a third of all documents is spread over all
buckets); a bucket leaves at most one open unit per source; ``fan_in`` buckets
combine their open units at the next level, until one is left per source, which
is rounded by itself.  From the second level on sources are dealt to groups by a hash,
as sources never meet: no group grows with their number.  Random numbers are hashes of
seed, level, source and unit, so reruns agree on any cluster.

Defined results: null texts have size 0; a unit of size 0 takes part with no
words; a null source is a source of its own, last in the order; every row is a unit,
rows that share their id (or have none) too: they are told apart by a 128-bit hash of
their columns, and wholly equal rows by a number; an empty
table gives an empty result; other columns are kept by ``mix_documents``.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import SEPARATOR_RUN, fresh, written

#: Weights of the sources in code point order, repeating, and the most copies of a unit.
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Units of a bucket, buckets that combine at a level of the tree, seed of the random numbers.
BUCKET_UNITS = 20_000
FAN_IN = 64
#: Rows that one element of an array of numbers stands for when equal rows are written out.
STRETCH = 4096
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null gives 0."""
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATOR_RUN)
    return (F.size(parts) - F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
            - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``place``: how many sources come before (code point order, null last).

    Sorted by range; only one count per partition meets the driver.
    """
    order = [F.col("source").isNull(), F.encode(F.coalesce(F.col("source"), F.lit("")), "UTF-8")]
    parts = written(sources.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("part", F.spark_partition_id())
                    .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "mix-sources")
    before, offsets = 0, []
    for r in parts.groupBy("part").agg((F.max("at") + 1).alias("n")).orderBy("part").collect():
        offsets.append((r.part, before))
        before += r.n
    spark = sources.sparkSession
    shift = spark.createDataFrame(offsets, "part int, before long")
    return parts.join(shift, "part").withColumn("place", F.col("before") + F.col("at")).drop("part", "at", "before")


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target``: all sizes shared by weight, no target above ``max_copies`` sizes.

    Each round fixes the targets that the present share would lift above their
    limit and shares what is left; a round is one sum over the sources.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = written(_ranked(sources).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1))
        .withColumn("most", F.col("source_size") * max_copies), "mix-targets")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        # above: weight * share > most; a source once at its limit stays there, as shares only grow
        over = (F.col("weight") * F.lit(share) > F.col("most")) if capped >= 0 else F.lit(False)
        r = table.agg(F.sum(F.when(over, F.col("most")).otherwise(0)).alias("fixed"),
                      F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open"),
                      F.sum(over.cast("int")).alias("n")).first()
        if r.n is None or not r.open or r.n == capped:
            break
        capped, share = r.n, (total - r.fixed) / r.open
    return table.select("source", "source_size", F.least(F.col("weight") * F.lit(share),
                                                         F.col("most").cast("double")).alias("target"))


def _chance(*parts: object) -> float:
    digest = hashlib.blake2b("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little") / 2.0**64


def pivot(ids: list, sizes: list[int], fractions: list[float], label: str) -> tuple[list[int], int | None, float]:
    """Pivotal rounding of one source's units, in the given order.

    Returns the rounded fractions (0 or 1), and the place and fraction of the unit
    that is still open, if any.
    """
    out = [0] * len(ids)
    held, f, s = None, 0.0, 0
    for k, size in enumerate(sizes):
        g = fractions[k]
        if size == 0 or g <= 1e-12 or g >= 1 - 1e-12:
            out[k] = int(g >= 0.5) if size else 0
            continue
        if held is None:
            held, f, s = k, g, size
            continue
        # words that can move from the held unit to this one, and the other way
        there = min(f * s, (1 - g) * size)
        back = min((1 - f) * s, g * size)
        move = there if _chance(label, ids[held], ids[k]) * (there + back) < back else -back
        f, g = f - move / s, g + move / size
        for unit, x in ((held, f), (k, g)):
            if x <= 1e-12 or x >= 1 - 1e-12:
                out[unit] = int(x >= 0.5)
        open_held, open_new = 1e-12 < f < 1 - 1e-12, 1e-12 < g < 1 - 1e-12
        if open_new:
            held, f, s = k, g, size
        elif not open_held:
            held = None
    return out, held, f


def land(sizes: list[int], due: list[float], rounded: list[int], miss: float) -> list[int]:
    """Flip rounded units, largest first, while that brings ``miss`` (words due less words taken) nearer to 0.

    The tree ends with one open unit per source, whose rounding can miss by half its size.
    """
    out = list(rounded)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        change = sizes[k] * (1 - 2 * out[k])
        if 1e-12 < due[k] < 1 - 1e-12 and abs(miss - change) < abs(miss):
            out[k], miss = 1 - out[k], miss - change
    return out


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["size", "unit"], ascending=[False, True], kind="stable").reset_index(drop=True)


def _rounder(level: int, last: bool):
    """Round a bucket's units; but for the last level one unit per source may stay open."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _sorted(pdf)
        fraction, still_open = pdf["fraction"].to_numpy(copy=True), pdf["open"].to_numpy(copy=True)
        still_open[:] = False
        for name, rows in pdf.groupby("source_key", sort=True).indices.items():
            ids, sizes = pdf["unit"].iloc[rows].to_list(), pdf["size"].iloc[rows].to_list()
            out, held, f = pivot(ids, sizes, fraction[rows].tolist(), f"{SEED}/{level}/{name}")
            fraction[rows] = out
            if held is not None:
                fraction[rows[held]] = float(f >= 0.5) if last else f
                still_open[rows[held]] = not last
        return pdf.assign(fraction=fraction, open=still_open)
    return run


def _lander(pdf: pd.DataFrame) -> pd.DataFrame:
    """Let the units of a bucket make up for the bucket's part of each source's miss."""
    pdf = _sorted(pdf)
    fraction = pdf["fraction"].to_numpy(copy=True)
    for _, rows in pdf.groupby("source_key", sort=True).indices.items():
        sizes, due = pdf["size"].iloc[rows].to_list(), pdf["due"].iloc[rows].to_list()
        able, total = int(pdf["able"].iloc[rows].sum()), int(pdf["total"].iloc[rows[0]])
        if able:
            fraction[rows] = land(sizes, due, fraction[rows].astype(int).tolist(),
                                  pdf["miss"].iloc[rows[0]] * able / total)
    return pdf.assign(fraction=fraction)[["source_key", "unit", "whole", "fraction"]]


_LEVEL = ("source_key string, unit string, size long, whole int, due double, home long, fraction double, open boolean, "
          "bucket long")


def level_groups(level: int, open_units: int, buckets: int, bucket_units: int) -> list[Column]:
    """What one task of a level holds: a bucket, and from level 1 on a share of the sources, by hash.

    A source has at most one open unit per bucket combined, so about ``bucket_units`` meet.
    """
    if level == 0:
        return [F.col("bucket")]
    shares = max(1, -(-open_units // (buckets * bucket_units)))
    return [F.col("bucket"), F.pmod(F.xxhash64("source_key"), F.lit(shares))]


def copies(units: DataFrame, bucket_units: int = BUCKET_UNITS, fan_in: int = FAN_IN) -> DataFrame:
    """``source_key, unit, copies`` from rows with ``source_key, unit, size, share`` (fractional copies, the same in a source)."""
    n = units.count()
    buckets = max(1, -(-n // bucket_units))
    level, done = 0, []
    home = F.pmod(F.xxhash64("unit"), F.lit(buckets))
    due = F.col("share") - F.floor("share")
    open_rows = units.select("source_key", "unit", "size", F.floor("share").cast("int").alias("whole"), due.alias("due"),
                             home.alias("home"), due.alias("fraction"), F.lit(True).alias("open"), home.alias("bucket"))
    while True:
        groups = level_groups(level, n, buckets, bucket_units)
        ruled = written(open_rows.groupBy(*groups).applyInPandas(_rounder(level, buckets == 1), schema=_LEVEL), "mix-level")
        done.append(ruled.where(~F.col("open")))
        if buckets == 1:
            break
        level, buckets = level + 1, max(1, -(-buckets // fan_in))
        n = ruled.where("open").count()
        open_rows = ruled.where("open").withColumn("bucket", F.floor(F.col("bucket") / fan_in))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # a source's miss is dealt to the buckets by the words that they can flip towards it; whole numbers are summed,
    # so that their order does not matter
    loose = (F.col("due") > 1e-12) & (F.col("due") < 1 - 1e-12)
    words = F.when(loose, F.col("size")).otherwise(0)
    miss = out.groupBy("source_key").agg(F.round(
        F.sum(words) * F.max("due") - F.sum(words * F.round("fraction").cast("long")), 3).alias("miss"))
    helps = (F.col("size") <= F.abs("miss")) & ((F.col("miss") > 0) == (F.col("fraction") < 0.5))
    out = written(out.join(miss, "source_key").withColumn("able", F.when(loose & helps, F.col("size")).otherwise(0)), "mix-miss")
    total = out.groupBy("source_key").agg(F.sum("able").alias("total"))
    landed = out.join(total, "source_key").groupBy("home").applyInPandas(
        _lander, schema="source_key string, unit string, whole int, fraction double")
    return landed.select("source_key", "unit", (F.col("whole") + F.round("fraction").cast("int")).alias("copies"))


def _keys(docs: DataFrame, id_col: str, source_col: str) -> tuple[Column, Column]:
    """Keys of a row's source and of the row: its id and a hash of all its columns."""
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    known = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    parts: list[Column] = []
    for field in docs.schema:
        c = F.col(f"`{field.name}`")
        parts += [c.isNull(), c if isinstance(field.dataType, T.AtomicType) else F.to_json(F.struct(c))]
    return key, F.concat_ws("/", known, *[F.hex(F.xxhash64(F.lit(seed), *parts)) for seed in (1, 2)])


def _stretched(rows: DataFrame, count: str, keys: list[str], name: str) -> DataFrame:
    """Each row ``count`` times, numbered from 1 in ``name``; many repeats of a row are dealt to tasks by stretches."""
    at = fresh("stretch", rows)
    return (rows.withColumn(at, F.explode(F.sequence(F.lit(0), F.floor((F.col(count) - 1) / STRETCH).cast("long"))))
            .repartition(*keys, at)
            .withColumn(name, F.explode(F.sequence(F.col(at) * STRETCH + 1,
                                                   F.least(F.col(count), (F.col(at) + 1) * STRETCH))))
            .drop(at))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, bucket_units: int = BUCKET_UNITS,
        fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, copies, taken and two key columns.

    ``unit`` is the same for wholly equal rows.
    """
    key, unit = _keys(docs, id_col, source_col)
    equal = (docs.select(F.col(source_col).cast("string").alias("source"), key.alias("source_key"),
                         unit.alias("row_key"), F.col(id_col).alias(id_col), word_count(F.col(text_col)).alias("size"))
             .groupBy("source", "source_key", "row_key", id_col, "size").agg(F.count("*").alias("rows")))
    units = written(_stretched(equal, "rows", ["source_key", "row_key"], "nth")
                    .withColumn("unit", F.concat_ws("/", "row_key", "nth")).drop("rows", "nth"), "mix-units")
    targets = source_targets(units, weights, max_copies).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source_key"), "source_size", "target")
    units = written(units.join(targets, "source_key").withColumn(
        "share", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)), "mix-shares")
    chosen = copies(units, bucket_units, fan_in)
    return (units.join(chosen, ["source_key", "unit"])
            .select(id_col, "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken"), "source_key", F.col("row_key").alias("unit")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  **options) -> DataFrame:
    """The mixed documents: each row as often as its copies, with the columns of ``docs``.

    Wholly equal rows are collapsed before the shuffle and written out as often as they are taken together.
    """
    key, unit = _keys(docs, id_col, source_col)
    k, u, c, n = (fresh(x, docs) for x in ("mix_source", "mix_unit", "mix_copies", "mix_rows"))
    chosen = written(mix(docs, id_col, text_col, source_col, **options)
                     .groupBy(F.col("source_key").alias(k), F.col("unit").alias(u))
                     .agg(F.sum("copies").alias(c), F.count("*").alias(n)).where(F.col(c) > 0), "mix-chosen")
    keyed = docs.withColumns({k: key, u: unit})
    one = (keyed.join(chosen.where(F.col(n) == 1), [k, u])
           .withColumn(c, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*docs.columns))
    equal = (keyed.join(chosen.where(F.col(n) > 1), [k, u]).groupBy(k, u)
             .agg(F.first(c).alias(c), F.first(F.struct(*docs.columns)).alias(n)))
    return one.unionByName(_stretched(equal, c, [k, u], fresh("mix_nth", docs)).select(f"{n}.*"))
