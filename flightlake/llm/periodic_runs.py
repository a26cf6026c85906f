"""Periodic runs of words by recompression (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and at least ``least_words`` words and ``periods`` periods, that no
neighbouring word extends.  Words of a run after its first q are its repetitions.

1. *Grammar.*  The words of a block of documents, numbered, with a word of its own
   after each document, are one string.  It is compressed in turns: equal neighbours
   become one symbol for (symbol, number), then symbols are dealt into left and right
   ones and each left one joins a right one behind it to one symbol.  Equal strings
   are compressed alike but at their ends, so a grammar of run lengths and pairs arises
   whose levels shrink by a constant factor.
2. *Extensions.*  How far two places agree is asked of the grammar, for many pairs at
   once.  Upwards: where one of the two is inside a symbol of the next level, the rest of
   it is compared, until both are at a symbol's end or differ.  Downwards: the symbols
   that differ are opened level by level, and what their beginnings share is counted.
   Both ways are the same code, with the other end of the symbols.
3. *Candidates.*  A run of period q holds two neighbouring places of the grid of
   multiples of q, and a third one, all with the same word.  For each q up to a third of
   a document these are its candidates, n log n in all; the grammar tells how far each
   extends both ways.  Candidates with the same ends are one run, its period the smallest.

Documents are independent: nothing is shuffled, and a task holds a block of
``BLOCK_WORDS`` words, or one longer document.

Defined results: a null or empty text, and one under ``least_words`` words, has no
run; repeated rows have equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import SEPARATOR_RUN
from flightlake.llm.textkit import mix, ranges

#: Least words and periods of a run.
LEAST_WORDS, PERIODS = 24, 3
#: Words of a block of documents, grid pairs looked at by one pass.
BLOCK_WORDS, PAIRS = 1 << 18, 1 << 21


class Grammar:
    """Levels of a recompressed string; ``extent`` tells how far places agree."""

    def __init__(self, symbols: np.ndarray):
        self.strings = [np.asarray(symbols, np.int64)]
        self.groups: list[np.ndarray] = []  # of each place, its place in the next level
        self.heads: list[np.ndarray] = []   # of each place of the next level, where it begins (and the end)
        self.widths = [np.arange(len(symbols) + 1)]  # where each place begins in words (and the end)
        while len(self.strings[-1]) > 1 and self._blocks() + self._pairs():
            pass

    def _add(self, begins: np.ndarray, keys: np.ndarray) -> bool:
        """A level whose places begin at ``begins``; equal rows of ``keys`` are one symbol."""
        s = self.strings[-1]
        if len(begins) == len(s):
            return False
        low = keys[1] - keys[1].min()
        _, names = np.unique(keys[0] * (int(low.max()) + 1) + low, return_inverse=True)
        heads = np.append(begins, len(s))
        self.groups.append(np.repeat(np.arange(len(begins)), np.diff(heads)))
        self.heads.append(heads)
        self.widths.append(self.widths[-1][heads])
        self.strings.append(names.astype(np.int64))
        return True

    def _blocks(self) -> bool:
        s = self.strings[-1]
        begins = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        return self._add(begins, np.stack([s[begins], np.diff(np.append(begins, len(s)))]))

    def _pairs(self) -> bool:
        s = self.strings[-1]
        best = None
        for turn in range(4):  # neighbours differ: a coin for each symbol joins a quarter of the places on average
            left = (mix(s.astype(np.uint64) + np.uint64(turn * 0x9E3779B9 + len(self.strings))) & np.uint64(1)).astype(bool)
            joined = left[:-1] & ~left[1:]
            if best is None or joined.sum() > best.sum():
                best = joined
        begins = np.flatnonzero(np.concatenate([[True], ~best]))
        second = np.where(np.append(best, False)[begins], s[np.minimum(begins + 1, len(s) - 1)] + 1, 0)
        return self._add(begins, np.stack([s[begins], second]))

    def extent(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """Number of words in which the texts from ``x`` and ``y`` on agree (``back``: up to and with them).

        Places x and y differ; a word that occurs once has to stand at the string's end.
        """
        x, y = np.array(x, np.int64), np.array(y, np.int64)
        out = np.zeros(len(x), np.int64)
        level = np.zeros(len(x), np.int64)  # where a difference was met
        alive = np.arange(len(x))
        origin = x.copy()
        step = -1 if back else 1
        top = len(self.groups)
        for t in range(top + 1):  # upwards
            s = self.strings[t]
            inside = (x[alive] >= 0) & (y[alive] >= 0) & (x[alive] < len(s)) & (y[alive] < len(s))
            level[alive[~inside]] = t
            alive = alive[inside]
            if t == top:  # nothing to compress is left: place by place
                level[alive] = t
                while len(alive):
                    alive = alive[s[x[alive]] == s[y[alive]]]
                    x[alive] += step
                    y[alive] += step
                    alive = alive[(np.minimum(x[alive], y[alive]) >= 0) & (np.maximum(x[alive], y[alive]) < len(s))]
                break
            rest_x, whole_x = self._rest(t, x[alive], back)
            rest_y, whole_y = self._rest(t, y[alive], back)
            odd = ~(whole_x & whole_y)
            same = s[x[alive]] == s[y[alive]]
            agree = np.where(odd & same, np.minimum(rest_x, rest_y), 0)
            x[alive] += step * agree
            y[alive] += step * agree
            # both parts end together, or they differ behind the shorter one
            over = odd & (~same | (rest_x != rest_y))
            level[alive[over]] = t
            alive = alive[~over]
            ends = (x[alive] < 0) | (y[alive] < 0) | (x[alive] >= len(s)) | (y[alive] >= len(s))
            level[alive[ends]] = t
            alive = alive[~ends]
            x[alive], y[alive] = self.groups[t][x[alive]], self.groups[t][y[alive]]
        for t in range(top - 1, -1, -1):  # downwards
            at = np.flatnonzero(level > t)
            if not len(at):
                continue
            s, heads = self.strings[t], self.heads[t]
            if back:
                x[at], y[at] = heads[x[at] + 1] - 1, heads[y[at] + 1] - 1
            else:
                x[at], y[at] = heads[x[at]], heads[y[at]]
            inside = (np.minimum(x[at], y[at]) >= 0) & (np.maximum(x[at], y[at]) < len(s))
            at = at[inside]
            at = at[s[x[at]] == s[y[at]]]
            agree = np.minimum(self._rest(t, x[at], back)[0], self._rest(t, y[at], back)[0])
            x[at] += step * agree
            y[at] += step * agree
        out[:] = (origin - x) if back else (x - origin)
        return out

    def _rest(self, t: int, x: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """Equal symbols from ``x`` to the end of its group, and whether it is the group's first (``back``: last)."""
        group = self.groups[t][x]
        lo, hi = self.heads[t][group], self.heads[t][group + 1]
        s = self.strings[t]
        block = s[lo] == s[hi - 1]  # a block, or a symbol alone; the others are pairs
        if back:
            return np.where(block, x - lo + 1, 1), x == hi - 1
        return np.where(block, hi - x, 1), x == lo


def runs_of(words: np.ndarray, first: np.ndarray, sizes: np.ndarray, least_words: int = LEAST_WORDS, periods: int = PERIODS
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of documents in a string, by start and period.

    ``first`` and ``sizes`` are the documents' places; behind each stands a word that occurs nowhere else.
    """
    least = np.maximum(least_words, periods)
    take = sizes >= least
    doc_first, doc_size = first[take], sizes[take]
    found: list[np.ndarray] = []
    # rows (document, period), in passes of about PAIRS grid places
    per_doc = doc_size // periods
    doc = np.repeat(np.arange(len(doc_size)), per_doc)
    q = ranges(np.ones(len(doc_size), np.int64), per_doc)
    grid = (doc_size[doc] - 1) // q if len(doc) else np.zeros(0, np.int64)
    cut = np.append(np.flatnonzero(np.diff(np.cumsum(grid) // PAIRS, prepend=-1)), len(grid))
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        n = grid[lo:hi]
        period = np.repeat(q[lo:hi], n)
        place = np.repeat(doc_first[doc[lo:hi]], n) + ranges(np.zeros(hi - lo, np.int64), n) * period
        equal = words[place] == words[place + period]
        # a run holds three grid places, whose words are equal
        both = np.flatnonzero(equal[:-1] & equal[1:] & (place[1:] == place[:-1] + period[:-1]) & (period[1:] == period[:-1]))
        found.append(np.stack([place[both], period[both]]))
    g, p = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    if not len(g):
        return g, g, p
    grammar = Grammar(words)
    ahead = grammar.extent(g, g + p)
    long = ahead > p  # the third place and what is between
    g, p, ahead = g[long], p[long], ahead[long]
    # of neighbouring grid places of a run the first one asks backwards
    order = np.lexsort((g, p))
    g, p, ahead = g[order], p[order], ahead[order]
    new = np.ones(len(g), bool)
    new[1:] = (p[1:] != p[:-1]) | (g[1:] + ahead[1:] != g[:-1] + ahead[:-1])
    g, p, ahead = g[new], p[new], ahead[new]
    behind = grammar.extent(g - 1, g + p - 1, back=True)
    start, end = g - behind, g + p + ahead
    whole = end - start >= np.maximum(least_words, periods * p)
    start, end, p = start[whole], end[whole], p[whole]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    once = np.ones(len(start), bool)
    once[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, p = start[once], end[once], p[once]
    order = np.lexsort((p, start))
    return start[order], (end - start)[order], p[order]


def best_run(runs: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; of equal ones that of smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
                  ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs", pa.string()),
                  ("collapsed", pa.string()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def _block(ids: list, texts: list[list[bytes]], least_words: int, periods: int) -> pa.RecordBatch:
    """Results of a block of documents."""
    names: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    string = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for f, words in zip(first.tolist(), texts, strict=True):
        string[f:f + len(words)] = [names.setdefault(w, len(names)) for w in words]
    string[first + sizes] = len(names) + np.arange(len(texts))
    start, length, period = runs_of(string, first, sizes, least_words, periods)
    owner = np.searchsorted(first, start, side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    columns: list[list] = [[] for _ in range(len(_OUT) - 2)]
    for i, words in enumerate(texts):
        mine = slice(cut[i], cut[i + 1])
        runs = list(zip((start[mine] - first[i]).tolist(), length[mine].tolist(), period[mine].tolist(), strict=True))
        best = best_run(runs)
        if runs:
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, [s + p for s, _, p in runs], 1)
            np.add.at(edge, [s + n for s, n, _ in runs], -1)
            keep = np.cumsum(edge[:-1]) == 0
            words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
        text = b" ".join(words)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        row = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, listed, text,
               sha256(listed.encode()).hexdigest(), sha256(text).hexdigest())
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64())]
    arrays += [pa.array(c, pa.binary()).cast(pa.string()) if f.name == "collapsed" else pa.array(c, f.type)
               for c, f in zip(columns, list(_OUT)[2:], strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_OUT)


def _finder(least_words: int, periods: int, names: Sequence[str]):
    keep = [f.name for f in _OUT if f.name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, total = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                words = (text.as_py() or b"").split()  # the white space of bytes is that of the word pattern
                if texts and total + len(words) > BLOCK_WORDS:
                    yield _block(ids, texts, least_words, periods).select(keep)
                    ids, texts, total = [], [], 0
                ids.append(doc)
                texts.append(words)
                total += len(words) + 1
            if texts:
                yield _block(ids, texts, least_words, periods).select(keep)
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
                  periods: int = PERIODS, columns: Sequence[str] = tuple(_OUT.names)) -> DataFrame:
    """For every row its runs (``n_runs``, the one of greatest exponent, all as text) and the text without repetitions.

    ``periods`` is at least 3 (then a run holds three grid places); ``columns`` are those of the result.
    """
    if periods < 3:
        raise ValueError("periods must be 3 or more")
    kinds = {f.name: "string" if pa.types.is_string(f.type) else "long" for f in _OUT}
    schema = ", ".join(f"{n} {kinds[n]}" for n in _OUT.names if n in columns)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(_finder(least_words, periods, columns), schema=schema).select(*columns)


def looped_tail(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Texts of every tenth document by crc32 of the id, with a tail that repeats its first words.

    With h the hash, g = h // 10 and n words, word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8).  Other texts, those without words and rows without id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), SEPARATOR_RUN), lambda w: w != "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    # whole arrays only: an expression inside a lambda would be computed again for every word
    loops = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.concat_ws(" ", F.slice(words, F.lit(1), a), F.slice(loops, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col(text_col))
