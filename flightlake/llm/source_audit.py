"""Source divergence audit over a K-squared tree of the group-term count matrix (operator 11).

Groups are the occurring (lang, source); a lang's columns are the terms that at least
``least_docs`` of its documents hold.  With ``count`` occurrences and N in all, a group
gives each of the V terms p = 1 + floor(10^9 (count + 1) / (N + V)).  Two shares p, q
of a term differ by floor((p - q)^2 / q).  Reported are, per group, the sum over all
terms against each other source of the lang (``pair``), and the terms that the group
uses more than its lang does (``term``, the first ``top`` of them).

1. *Matrix.*  A task counts the words of its documents per group and sends each
   (group, term) once; sums are laid out by (lang, term), where document counts and
   the lang's own counts follow.  Only nonzero entries exist.
2. *Tiles.*  A lang's terms are dealt by hash into blocks of about ``TILE`` entries, its
   groups by number into blocks of ``ROWS``; a tile has one block of terms and two of groups.
3. *Tree.*  In a tile, columns are ordered by the groups that hold them, and each
   quadrant of the matrix is cut into K x K ones as long as it has entries.  The two rows of
   a pair go down together: a quadrant empty in both is priced at once, as its columns times
   the one difference of two zero counts; where either has entries the descent goes on to the
   leaves.  Pairs are taken both ways round at the leaf.  Terms of a block that no group of the tile
   holds are priced like an empty quadrant, with the sums of all tiles.

Whole numbers throughout: 64 bits hold a difference (at most 10^18) and sums of less
than 2 * 10^9 terms; counts are multiplied as decimals.

Defined results: null text, lang and source are empty strings; a group without terms
has pairs but no ``term`` rows; in a lang without kept terms all pairs are 0; a lang of
one source has no pairs; rows repeated as a whole are documents each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import written

#: Shares are counted in parts of this (fixed value).
SHARE = 1_000_000_000
#: Documents that hold a kept term, ranks of the ``term`` part.
LEAST_DOCS, TOP = 3, 200
#: Quadrants a side, entries of a tile on average, groups of a block, frontier places of a descent.
K, TILE, ROWS, FRONTIER = 4, 200_000, 64, 1 << 19
#: Different (group, term) counts that a task holds before it sends them.
HELD = 1_000_000
#: Groups up to which their totals are broadcast.
MAX_BROADCAST_GROUPS = 200_000

#: Bytes of terms: A-Z in lower case, a-z and all above ASCII; every other byte parts them (fixed values).
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())])


def _counter(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}
        size = 0
        for batch in batches:
            for text, lang, source in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(),
                                          batch.column(2).to_pylist(), strict=True):
                found = text.as_py().translate(_TERM_BYTES).split()
                if (lang, source) not in words:
                    words[lang, source], docs[lang, source] = Counter(), Counter()
                mine = words[lang, source]
                size -= len(mine)
                mine.update(found)
                size += len(mine)
                docs[lang, source].update(set(found))
                if size > held:
                    yield from _sent(words, docs)
                    words, docs, size = {}, {}, 0
        yield from _sent(words, docs)
    return run


def _sent(words: dict[tuple, Counter], docs: dict[tuple, Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, source), mine in words.items():
        held = docs[lang, source]
        terms = list(mine)
        for lo in range(0, len(terms), 50_000):
            part = terms[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                 pa.array(part, pa.binary()).cast(pa.string()), pa.array([mine[t] for t in part], pa.int64()),
                 pa.array([held[t] for t in part], pa.int64())], schema=_COUNTS)


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SHARE (count + 1) / (n + v)); 1 where there are no terms."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    top = wide(F.lit(SHARE), 10) * wide(count + 1, 20)
    return 1 + F.when(v > 0, F.call_function("div", top, wide(n + v, 20))).otherwise(F.lit(0))


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class KSquaredTree:
    """Nonempty quadrants of a sparse matrix, level by level, each with its K x K parts (-1: empty)."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int):
        self.n_cols = n_cols
        self.depth = 1
        while K ** self.depth < max(n_rows, n_cols):
            self.depth += 1
        code = np.zeros(len(rows), np.int64)
        for level in range(self.depth - 1, -1, -1):
            code = code * K * K + rows // K ** level % K * K + cols // K ** level % K
        self.leaf = np.argsort(code, kind="stable")
        keys = code[self.leaf]
        self.parts: list[np.ndarray] = []
        for _ in range(self.depth):
            above, at = np.unique(keys // (K * K), return_inverse=True)
            parts = np.full((len(above) + 1, K * K), -1, np.int64)  # the last row stands for an empty quadrant
            parts[at, keys % (K * K)] = np.arange(len(keys))
            self.parts.insert(0, parts)
            keys = above

    def descend(self, g: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both rows of every pair together: (pair, entry of g, entry of s) of the leaves, -1 for a zero count,
        and per pair the number of columns in quadrants that are empty in both rows."""
        zeros = np.zeros(len(g), np.int64)
        pair = np.arange(len(g))
        none = len(self.leaf) == 0
        a = np.full(len(g), -1 if none else 0)
        b, start = a.copy(), np.zeros(len(g), np.int64)
        for level in range(self.depth):
            width = K ** (self.depth - 1 - level)
            column = np.arange(K)
            x = self.parts[level][a[:, None], (g[pair] // width % K * K)[:, None] + column]
            y = self.parts[level][b[:, None], (s[pair] // width % K * K)[:, None] + column]
            at = start[:, None] + column * width
            inside = at < self.n_cols
            empty = inside & (x < 0) & (y < 0)
            zeros += np.bincount(np.repeat(pair, K)[empty.ravel()], minlength=len(g),
                                 weights=np.minimum(width, self.n_cols - at)[empty]).astype(np.int64)
            on = inside & ~empty
            pair, a, b, start = np.repeat(pair, K)[on.ravel()], x[on], y[on], at[on]
        leaf = np.append(self.leaf, -1)
        return pair, leaf[a], leaf[b], zeros


def pair_sums(rows: np.ndarray, cols: np.ndarray, p: np.ndarray, p0: np.ndarray, n_cols: int, g: np.ndarray, s: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """Sums of differences over all columns for the pairs (g, s) and for (s, g)."""
    seen = np.zeros((n_cols, len(p0)), bool)
    seen[cols, rows] = True
    packed = np.packbits(seen, axis=1)
    place = np.empty(n_cols, np.int64)
    place[np.lexsort(packed.T[::-1])] = np.arange(n_cols)  # columns of the same groups are neighbours
    tree = KSquaredTree(rows, place[cols], len(p0), n_cols)
    entries = np.bincount(rows, minlength=len(p0))
    work = np.cumsum(entries[g] + entries[s] + K)
    cut = np.append(np.flatnonzero(np.diff(work // FRONTIER, prepend=-1)), len(g))
    there, back = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        gs, ss = g[lo:hi], s[lo:hi]
        pair, a, b, zeros = tree.descend(gs, ss)
        x = np.where(a >= 0, p[a] if len(p) else 0, p0[gs][pair])
        y = np.where(b >= 0, p[b] if len(p) else 0, p0[ss][pair])
        square = (x - y) ** 2
        np.add.at(there[lo:hi], pair, square // y)
        np.add.at(back[lo:hi], pair, square // x)
        square = (p0[gs] - p0[ss]) ** 2
        there[lo:hi] += zeros * (square // p0[ss])
        back[lo:hi] += zeros * (square // p0[gs])
    return there, back


_PAIR_SQL = "lang string, source string, item string, value long, cols long, zero long, v long"


def _tile(table: pa.Table) -> pa.Table:
    """Sums of all ordered pairs of a tile; its heads (term null) are the groups, with the share of a zero count."""
    heads = table.filter(pc.is_null(table.column("term")))
    entries = table.filter(pc.is_valid(table.column("term")))
    number = heads.column("row").to_numpy()
    order = np.argsort(number)
    number, p0 = number[order], heads.column("p").to_numpy()[order]
    names = heads.column("source").take(pa.array(order))
    rows = np.searchsorted(number, entries.column("row").to_numpy())
    terms = entries.column("term").combine_chunks().dictionary_encode()
    cols = terms.indices.to_numpy().astype(np.int64)
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    part = number // ROWS
    g, s = np.nonzero((part[:, None] == low) & (part[None, :] == high) & (number[:, None] < number[None, :]))
    n_cols = len(terms.dictionary)
    there, back = pair_sums(rows, cols, entries.column("p").to_numpy(), p0, n_cols, g, s)
    first, second = np.concatenate([g, s]), np.concatenate([s, g])
    zero = (p0[first] - p0[second]) ** 2 // p0[second]
    many = len(first)
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * many, pa.string()),
                     "source": names.take(pa.array(first)), "item": names.take(pa.array(second)),
                     "value": pa.array(np.concatenate([there, back])), "cols": pa.array(np.full(many, n_cols)),
                     "zero": pa.array(zero), "v": pa.array(np.full(many, heads.column("v")[0].as_py() if many else 0))})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP, tile: int = TILE, held: int = HELD,
          max_broadcast_groups: int = MAX_BROADCAST_GROUPS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of the ``pair`` and ``term`` parts."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    counts = texts.mapInArrow(_counter(held), schema="lang string, source string, term string, count long, docs long")
    by_term = Window.partitionBy("lang", "term")
    matrix = (counts.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
              .select("lang", "source", "term", "count", F.sum("docs").over(by_term).alias("df"),
                      F.sum("count").over(by_term).alias("lang_count"),
                      (F.col("source") == F.min("source").over(by_term)).alias("lead"))
              .where(F.col("df") >= least_docs).drop("df"))
    matrix = written(matrix, "audit-matrix")
    # totals: a row per group and per lang
    langs = matrix.groupBy("lang").agg(F.count_if("lead").alias("v"), F.count("*").alias("entries"), F.sum("count").alias("lang_n"))
    mine = matrix.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    known = texts.select("lang", "source").distinct()
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = (known.join(mine, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n", "v", "entries", "lang_n"])
              .withColumn("row", (F.row_number().over(numbered) - 1).cast("long"))
              .withColumn("blocks", F.ceil(F.greatest("entries", F.lit(1)) / tile))
              .withColumn("sides", F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / ROWS) + 1)
              .withColumn("p0", _share(F.lit(0), F.col("n"), F.col("v"))))
    groups = written(groups, "audit-groups")
    small = F.broadcast(groups) if groups.count() <= max_broadcast_groups else groups
    shares = (matrix.join(small, ["lang", "source"])
              .withColumns({"p": _share(F.col("count"), F.col("n"), F.col("v")),
                            "q": _share(F.col("lang_count"), F.col("lang_n"), F.col("v"))}))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shares.where((F.col("count") > 0) & (F.col("p") > F.col("q")))
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     _difference(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))
    # tiles: each entry goes to every pair of group blocks with its own
    side = F.floor(F.col("row") / ROWS)
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)).alias("other")
    lay = lambda df: df.select("*", spread).select(
        "lang", "source", "row", "block", "term", "p", "v", F.least(side, "other").alias("low"), F.greatest(side, "other").alias("high"))
    entries = lay(shares.withColumn("block", F.pmod(F.xxhash64("term"), "blocks")))
    heads = lay(groups.withColumns({"term": F.lit(None).cast("string"), "p": F.col("p0")})
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    sums = (entries.select(*entries.columns).withColumn("source", F.lit(None).cast("string")).unionByName(heads)
            .groupBy("lang", "block", "low", "high").applyInArrow(_tile, schema=_PAIR_SQL)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("cols").alias("cols"),
                                                   F.max("zero").alias("zero"), F.max("v").alias("v")))
    pairs = (sums.select("lang", "source", F.lit("pair").alias("part"), "item",
                         (F.col("value") + (F.col("v") - F.col("cols")) * F.col("zero")).alias("value"))
             .withColumn("rank", F.row_number().over(best)))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def sql(least_docs: int = LEAST_DOCS, top: int = TOP) -> str:
    """The same in DuckDB SQL, over every pair and term."""
    return rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source FROM documents),
        words AS (
            SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM texts),
        kept AS (
            SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM words GROUP BY lang, term
            HAVING count(DISTINCT doc) >= {least_docs}),
        langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(c) AS n FROM kept GROUP BY lang),
        counts AS (
            SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM words JOIN kept USING (lang, term)
            GROUP BY lang, source, term),
        groups AS (
            SELECT lang, source, coalesce(v, 0) AS v, coalesce(l.n, 0) AS lang_n, coalesce(m.n, 0) AS n
            FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN langs l USING (lang)
            LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source) m USING (lang, source)),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS p,
                   1 + (1000000000 * (k.c + 1)) // (g.lang_n + g.v) AS q
            FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
            UNION ALL
            SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b USING (lang)
            WHERE a.source <> b.source AND a.v = 0
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
        WHERE part = 'pair' OR rank <= {top}"""
