"""Quality classifier: a byte-level convolutional network in numpy (operator 4).

Bytes are embedded, ``FILTERS`` learned filters of ``WIDTH`` bytes run over every
place, their outputs are max-pooled over chunks of ``CHUNK`` bytes that overlap by
half, a small layer turns the pooled vector of a chunk into a log-odds, and the
mean over all chunks of the document gives one probability.  Scoring reads every
byte of every text, in blocks, and shuffles nothing.

The network is fitted on a bounded sample of labelled rows (``rows``, a parameter)
with Adam; of a sampled text each epoch takes at most ``chunks`` chunks, spread
over the whole text.  The seed is fixed: reruns agree.

Defined results: null and empty texts are one chunk of padding and get a score;
repeated rows get equal scores; ids and other columns are never inputs; an empty
table gives an empty result; without labelled rows (or with a single class) every
score is that class's smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import fresh
from flightlake.llm.sampling import labelled_sample
from flightlake.llm.textkit import text_blocks

CHUNK, HALF = 256, 128
WIDTH, DIMS, FILTERS, HIDDEN = 6, 4, 16, 8
#: Most labelled rows of the fit, chunks of a text in an epoch, epochs, texts of a step, step size, seed.
ROWS, CHUNKS, EPOCHS, BATCH, RATE, SEED = 4000, 8, 8, 32, 0.01, 11
#: Least number of steps: small samples are gone over more often.
LEAST_STEPS = 600
SCORE_BLOCK = 1 << 18


def new_net(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)
    return {"embed": normal(256, DIMS, scale=0.5), "filters": normal(WIDTH * DIMS, FILTERS, scale=0.4),
            "shift": np.zeros(FILTERS, np.float32), "layer": normal(FILTERS, HIDDEN, scale=0.3),
            "layer_shift": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32)}


def chunk_logits(net: dict[str, np.ndarray], pooled: np.ndarray) -> np.ndarray:
    hidden = np.tanh(np.maximum(pooled, 0) @ net["layer"] + net["layer_shift"])
    return hidden @ net["out"] + net["bias"][0]


def _windows(net: dict[str, np.ndarray], data: np.ndarray) -> np.ndarray:
    """Rows of ``WIDTH`` embedded bytes, one per place (``data`` carries WIDTH - 1 bytes of padding)."""
    x = net["embed"][data]
    view = np.lib.stride_tricks.sliding_window_view(x.reshape(-1), WIDTH * DIMS)[::DIMS]
    return np.ascontiguousarray(view)


def score_texts(net: dict[str, np.ndarray], data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Probabilities of the documents ``data[bounds[i]:bounds[i+1]]``, every byte of them."""
    n_docs = len(bounds) - 1
    sizes = np.diff(bounds)
    halves = np.maximum(-(-sizes // HALF), 1)
    pooled = np.empty((int(halves.sum()), FILTERS), np.float32)
    first = np.concatenate([[0], np.cumsum(halves)])
    doc = 0
    while doc < n_docs:
        # texts of about SCORE_BLOCK bytes; a longer one goes by itself, a stretch of halves at a time
        stop = min(n_docs, max(doc + 1, int(np.searchsorted(bounds, bounds[doc] + SCORE_BLOCK, side="right")) - 1))
        if stop == doc + 1:
            text = data[bounds[doc]:bounds[stop]]
            for lo in range(0, max(len(text), 1), SCORE_BLOCK):
                part = text[lo:lo + SCORE_BLOCK]
                ahead = text[lo + SCORE_BLOCK: lo + SCORE_BLOCK + WIDTH - 1]
                padded = np.zeros(max(len(part), 1) + WIDTH - 1, np.uint8)
                padded[:len(part)] = part
                padded[len(part):len(part) + len(ahead)] = ahead
                z = _windows(net, padded) @ net["filters"] + net["shift"]
                at = first[doc] + lo // HALF
                cuts = np.arange(0, len(z), HALF)
                pooled[at:at + len(cuts)] = np.maximum.reduceat(z, cuts, axis=0)
        else:
            own = np.maximum(sizes[doc:stop], 1)
            begin = np.concatenate([[0], np.cumsum(own + WIDTH - 1)])
            padded = np.zeros(int(begin[-1]), np.uint8)
            for k in range(stop - doc):
                a, b = bounds[doc + k], bounds[doc + k + 1]
                padded[begin[k]:begin[k] + b - a] = data[a:b]
            z = _windows(net, np.concatenate([padded, np.zeros(WIDTH - 1, np.uint8)])) @ net["filters"] + net["shift"]
            z[np.arange(len(z)) >= np.repeat(begin[:-1] + own, own + WIDTH - 1)] = -np.inf  # places behind a text
            h = halves[doc:stop]
            cuts = np.repeat(begin[:-1] - HALF * (np.cumsum(h) - h), h) + HALF * np.arange(int(h.sum()))
            pooled[first[doc]:first[stop]] = np.maximum.reduceat(z, cuts, axis=0)
        doc = stop
    chunks = np.maximum(halves - 1, 1)
    at = np.repeat(first[:-1] - (np.cumsum(chunks) - chunks), chunks) + np.arange(int(chunks.sum()))
    last = np.repeat(first[1:] - 1, chunks)
    logits = chunk_logits(net, np.maximum(pooled[at], pooled[np.minimum(at + 1, last)]))
    mean = np.add.reduceat(logits, np.cumsum(chunks) - chunks) / chunks
    return 1.0 / (1.0 + np.exp(-np.clip(mean.astype(np.float64), -40, 40)))


def _training_chunks(texts: list[bytes], rng: np.random.Generator, chunks: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of every text (spread evenly where there are more than ``chunks``) and their text's place."""
    rows, owner = [], []
    for k, t in enumerate(texts):
        n = max(-(-len(t) // HALF) - 1, 1)
        take = np.arange(n) if n <= chunks else (np.arange(chunks) + rng.random(chunks)) * n // chunks
        for c in take.astype(int):
            part = t[c * HALF: c * HALF + CHUNK + WIDTH - 1]
            rows.append(part.ljust(CHUNK + WIDTH - 1, b"\0"))
            owner.append(k)
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, CHUNK + WIDTH - 1), np.array(owner)


def _step(net: dict[str, np.ndarray], data: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy of one batch of texts."""
    m = len(data)
    x = net["embed"][data].reshape(m, -1)
    win = np.lib.stride_tricks.sliding_window_view(x, WIDTH * DIMS, axis=1)[:, ::DIMS]
    z = np.ascontiguousarray(win).reshape(-1, WIDTH * DIMS) @ net["filters"] + net["shift"]
    z = z.reshape(m, CHUNK, FILTERS)
    place = z.argmax(axis=1)
    pooled = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0]
    relu = np.maximum(pooled, 0)
    hidden = np.tanh(relu @ net["layer"] + net["layer_shift"])
    per_text = np.bincount(owner, minlength=len(y))
    logit = np.bincount(owner, weights=hidden @ net["out"] + net["bias"][0], minlength=len(y)) / per_text
    d_text = (1 / (1 + np.exp(-logit)) - y) / len(y) / per_text
    d = d_text[owner].astype(np.float32)
    d_hidden = d[:, None] * net["out"] * (1 - hidden ** 2)
    d_pooled = (d_hidden @ net["layer"].T) * (pooled > 0)
    best = win[np.arange(m)[:, None], place]  # chunk, filter, window
    d_window = d_pooled[:, :, None] * net["filters"].T[None]
    d_embed = np.zeros_like(net["embed"])
    bytes_at = data[np.arange(m)[:, None, None], place[:, :, None] + np.arange(WIDTH)]
    flat = bytes_at.reshape(-1)
    parts = d_window.reshape(-1, DIMS)
    for j in range(DIMS):
        d_embed[:, j] = np.bincount(flat, weights=parts[:, j], minlength=256)
    return {"embed": d_embed, "filters": np.einsum("mf,mfw->wf", d_pooled, best), "shift": d_pooled.sum(0),
            "layer": relu.T @ d_hidden, "layer_shift": d_hidden.sum(0), "out": hidden.T @ d,
            "bias": np.array([d.sum()], np.float32)}


def fit(sample: pd.DataFrame, epochs: int = EPOCHS, chunks: int = CHUNKS, seed: int = SEED,
        least_steps: int = LEAST_STEPS) -> dict[str, np.ndarray]:
    """Fit the network to columns ``text`` and ``y`` of a bounded sample."""
    rng = np.random.default_rng(seed)
    net = new_net(rng)
    y = sample["y"].to_numpy(dtype=np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or share * (len(y) + 2) - 1 in (0, len(y)):
        net["out"][:] = 0
        net["bias"][0] = np.log(share / (1 - share))
        return net
    texts = [t.encode("utf-8", "surrogatepass") for t in sample["text"]]
    net["bias"][0] = np.log(share / (1 - share))
    m = {k: np.zeros_like(v) for k, v in net.items()}
    s = {k: np.zeros_like(v) for k, v in net.items()}
    per_epoch = -(-len(texts) // BATCH)
    epochs = max(epochs, -(-least_steps // per_epoch))
    t, total = 0, epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            data, owner = _training_chunks([texts[r] for r in rows], rng, chunks)
            t += 1
            rate = RATE * (1 - 0.95 * t / total)
            for k, g in _step(net, data, owner, y[rows]).items():
                g = g + 1e-5 * net[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                net[k] -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)
    return net


def _scorer(net: dict[str, np.ndarray], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            score = np.empty(len(texts))
            for row, data, bounds in text_blocks(texts):
                score[row:row + len(bounds) - 1] = score_texts(net, data, bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)],
                                             names=[*batch.schema.names[:-1], out])
    return run


def score(docs: DataFrame, net: dict[str, np.ndarray], keep: list[str], text_col: str = "text",
          out: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``out``, the probability of label 1 of the whole text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    schema = rows.select(*keep).schema.add(out, "double")
    return rows.mapInArrow(_scorer(net, out), schema=schema)


def accepted(docs: DataFrame, net: dict[str, np.ndarray], text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more."""
    out = fresh("quality_score", docs)
    return score(docs, net, docs.columns, text_col, out).where(F.col(out) >= least).drop(out)


def fit_labels(docs: DataFrame, labels: DataFrame, label: str = "quality", learn=None, rows: int = ROWS,
               **options) -> dict[str, np.ndarray]:
    return fit(labelled_sample(docs, labels, label, rows, learn), **options)
