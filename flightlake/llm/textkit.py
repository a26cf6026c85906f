"""Shared text helpers of the llm subpackage: words, word hashes and shingles with numpy.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.  All of these
separators are single bytes below 0x80, so splitting the UTF-8 bytes gives the
same words as splitting the characters.  Everything here works on a whole Arrow
batch at once, cut into blocks of documents so that memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The separators of the word pattern, as bytes.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Words per shingle of the near-duplicate operators.
SHINGLE = 5
#: Bytes of text handled by one numpy pass (a longer document is a pass of its own).
BLOCK_BYTES = 1 << 20

IS_SEP = np.zeros(256, dtype=bool)
IS_SEP[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n, kept per process."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        inv = pow(base, -1, 1 << 64)
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, inv, dtype=np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0], have[1]


def prefix_hash(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Running sums from which the hash of any substring follows (see ``span_hash``)."""
    up, _ = powers(len(data) + 1, base)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; equal spans have equal hashes."""
    _, down = powers(len(sums), base)
    length = (end - start).astype(np.uint64)
    return mix((sums[end] - sums[start]) * down[start] + length * np.uint64(0xD6E8FEB86659FD93))


def text_blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, bytes, bounds)`` for blocks of whole documents; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    bounds = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    bounds = bounds[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(bounds, bounds[row] + block_bytes, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield row, raw[bounds[row]: bounds[stop]], bounds[row: stop + 1] - bounds[row]
        row = stop


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word and, per document, the index of its first word (n + 1 entries)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~IS_SEP[data]
    start = inside[1:] & ~inside[:-1]
    stop = ~inside[1:] & inside[:-1]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    joint = cut[inside[cut] & inside[cut + 1]]  # two documents meet inside a run
    start[joint] = True
    stop[joint] = True
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop)
    return starts, ends, np.searchsorted(starts, bounds)


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``size``-word shingle and per-document bounds into them (repeats kept).

    Letters A-Z are lower-cased.  A document of fewer words gives its whole word
    sequence as one shingle, a document without words none.
    """
    low = LOWER[data]
    starts, ends, first = word_spans(low, bounds)
    words = span_hash(prefix_hash(low), starts, ends)
    counts = np.diff(first)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    total = int(out_bounds[-1])
    doc = np.repeat(np.arange(len(counts)), made)
    at = first[:-1][doc] + (np.arange(total) - out_bounds[:-1][doc])
    width = np.minimum(counts[doc], size)
    acc = np.zeros(total, dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for j in range(size):
        acc += np.where(j < width, padded[at + j] * _PLACE[j], np.uint64(0))
    return mix(acc + width.astype(np.uint64) * _PLACE[63]), out_bounds


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenate ``arange(start, start + count)`` for every pair."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(np.asarray(starts, dtype=np.int64) - (ends - counts), counts)
