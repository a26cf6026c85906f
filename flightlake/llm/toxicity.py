"""Toxicity: a counterfactual-regularised classifier (operator 2).

A document is the set of its different words (ASCII letters lower-cased, marks at
both ends stripped); a word stands for itself and for its first 4 to 7 letters.
Logistic regression over the features that tell the classes apart in a bounded
sample of labelled rows (``rows`` and ``features`` are parameters) is fitted with
two penalties: the usual square of the weights, and the counterfactual one: in
every labelled sentence that names a group of people, the term is swapped for the
other terms of its list, and the squared change of the score is added to the loss.
Group terms therefore end up with (nearly) equal weights, and since they occur in
clean sentences too, a neutral mention does not raise a score.

Scoring reads whole texts and shuffles nothing.

Defined results: null and empty texts get the score of a text without known
words; repeated rows get equal scores; other columns are never inputs; an empty
table gives an empty result; without labelled rows, or with one class only, the
score is the smoothed share of toxic rows.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.sampling import labelled_sample

#: Most labelled rows of the fit, features kept, least texts of a feature, texts of a swap list per term.
ROWS, FEATURES, LEAST_TEXTS = 12_000, 4000, 4
STEPS, RATE, RIDGE, SWAP = 400, 0.2, 2e-4, 1.0
PREFIXES = (4, 5, 6, 7)
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Terms that name groups of people; terms of one line are swapped for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "african", "european", "mexican", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
)
_SWAPS = {t: [o for o in line if o != t] for line in IDENTITY_TERMS for t in line}


def features_of(word: str) -> list[str]:
    """Features of a (lower-cased) word: itself and its beginnings."""
    w = word.strip(MARKS)
    if not w:
        return []
    return ["=" + w, *[w[:n] for n in PREFIXES if len(w) > n or len(w) == n]]


def _words(text: str) -> list[str]:
    return re.split(r"[\x20\x09-\x0D]+", text.lower())


def _indices(words, place: dict[str, int]) -> list[int]:
    return [place[f] for w in words for f in features_of(w) if f in place]


def swapped_pairs(text: str, place: dict[str, int]) -> list[tuple[list[int], list[int]]]:
    """Feature lists of a sentence and of its counterfactual, for every term and swap in ``text``."""
    out = []
    for sentence in re.split(r"[.!?\n]+", text.lower()):
        words = [w.strip(MARKS) for w in _words(sentence)]
        for at, w in enumerate(words):
            for other in _SWAPS.get(w, ()):
                out.append((_indices(sorted(set(words)), place),
                            _indices(sorted({*words[:at], other, *words[at + 1:]}), place)))
    return out


def _word_set(text: str) -> tuple[str, ...]:
    """The different words in order; equal words of all texts are one string object."""
    return tuple(sorted({sys.intern(w) for w in _words(text)}))


def _choose(texts: list[tuple[str, ...]], y: np.ndarray, features: int) -> dict[str, int]:
    """The features whose presence differs most between the classes (chi-square), and all group terms."""
    seen, bad = Counter(), Counter()
    for words, label in zip(texts, y, strict=True):
        found = {f for w in words for f in features_of(w)}
        seen.update(found)
        if label:
            bad.update(found)
    n, b = len(y), float(y.sum())
    scored = []
    for f, k in seen.items():
        if k >= LEAST_TEXTS:
            expect = k * b / n
            chi = (bad[f] - expect) ** 2 / expect + (bad[f] - expect) ** 2 / (k - expect) if 0 < expect < k else 0.0
            scored.append((-chi, f))
    kept = [f for chi, f in sorted(scored)[:features] if chi < -6.63]  # one per cent point, one degree
    kept += ["=" + t for t in sorted(_SWAPS) if "=" + t in seen]
    return {f: i for i, f in enumerate(dict.fromkeys(kept))}


def _pair_rows(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return rows, np.array([i for x in lists for i in x], dtype=np.int64)


def fit(sample: pd.DataFrame, features: int = FEATURES, swap: float = SWAP, steps: int = STEPS) -> dict[str, float]:
    """Weights by feature; the key ``""`` holds the bias."""
    y = sample["y"].to_numpy(dtype=np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.sum() in (0, len(y)):
        return {"": start}
    texts = [_word_set(t) for t in sample["text"]]
    place = _choose(texts, y, features)
    if not place:
        return {"": start}
    rows, cols = _pair_rows([_indices(t, place) for t in texts])
    pairs = [p for t in sample["text"] for p in swapped_pairs(t, place)]
    a_rows, a_cols = _pair_rows([p[0] for p in pairs])
    b_rows, b_cols = _pair_rows([p[1] for p in pairs])
    n, k = len(y), len(place)
    w, bias = np.zeros(k), start
    m, v, bm, bv = np.zeros(k), np.zeros(k), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(rows, weights=w[cols], minlength=n), -40, 40)))
        d = (p - y) / n
        g = np.bincount(cols, weights=d[rows], minlength=k) + RIDGE * w
        if pairs and swap:
            change = (np.bincount(a_rows, weights=w[a_cols], minlength=len(pairs))
                      - np.bincount(b_rows, weights=w[b_cols], minlength=len(pairs))) * (2 * swap / len(pairs))
            g += np.bincount(a_cols, weights=change[a_rows], minlength=k)
            g -= np.bincount(b_cols, weights=change[b_rows], minlength=k)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        bm, bv = 0.9 * bm + 0.1 * d.sum(), 0.99 * bv + 0.01 * d.sum() ** 2
        rate = RATE * (1 - 0.9 * t / steps)
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        bias -= rate * (bm / (1 - 0.9 ** t)) / (np.sqrt(bv / (1 - 0.99 ** t)) + 1e-8)
    return {"": float(bias), **{f: float(w[i]) for f, i in place.items() if abs(w[i]) > 1e-6}}


def score_texts(weights: dict[str, float], texts: pa.Array) -> np.ndarray:
    """Scores of whole texts; the different words of the batch are looked up once."""
    texts = texts.fill_null("")
    words = pc.list_flatten(lists := pc.ascii_split_whitespace(pc.ascii_lower(texts))).dictionary_encode()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    if not len(words):
        value, code = np.zeros(0), np.zeros(0, np.int64)
    else:
        # words that agree in lower case and without marks are one word
        clean = pa.array([w.lower().strip(MARKS) for w in words.dictionary.to_pylist()], pa.string()).dictionary_encode()
        value = np.array([sum(weights.get(f, 0.0) for f in features_of(w)) for w in clean.dictionary.to_pylist()])
        code = clean.indices.to_numpy()[words.indices.to_numpy()].astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    hit = value[code] != 0 if len(code) else np.zeros(0, bool)
    once = np.unique(doc[hit] * max(len(value), 1) + code[hit])
    total = np.bincount(once // max(len(value), 1), weights=value[once % max(len(value), 1)] if len(once) else None,
                        minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(weights[""] + total, -40, 40)))


def _scorer(weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            parts = [score_texts(weights, texts.slice(lo, 512)) for lo in range(0, len(texts), 512)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate(parts) if parts else np.zeros(0))],
                names=[*batch.schema.names[:-1], "score"])
    return run


def score(docs: DataFrame, weights: dict[str, float], keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``score``, the probability of being toxic, of the whole text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    schema = rows.select(*keep).schema.add("score", "double")
    return rows.mapInArrow(_scorer(weights), schema=schema)


def fit_labels(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn=None, rows: int = ROWS,
               **options) -> dict[str, float]:
    return fit(labelled_sample(docs, labels, label, rows, learn), **options)
