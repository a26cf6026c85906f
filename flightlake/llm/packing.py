"""Order-preserving packing into fixed windows by dynamic programming (operator 5).

Documents are tokenised, end with an end id each, and follow one another in the
order of the input within each partition.  A sequence is a stretch of this token
stream of at most ``window`` ids.  Cuts may lie at document ends, at sentence ends
(a word that ends in ``. ! ?``) and, where a sentence is longer than ``grid`` ids,
at every ``grid``-th id of it.  With ``p`` the places of the cuts,

    cost[j] = min over i, p[j] - p[i] <= window, of cost[i] + window - (p[j] - p[i]) + penalty[j]

so padding and truncation are weighed against each other.  The minimum of
``cost[i] + p[i]`` over the sliding window is kept in a monotone queue: every cut
enters and leaves it once.  The stream is solved block by block; the last, still
open sequence of a block is carried into the next one.  At the end of a partition
the rest is padded, or cut into powers of two (which need no padding) if that is cheaper.

A task holds one block of tokens, whatever the size of the partition; nothing is shuffled.

Tokenising works on the different words of a slice of a block: white space always separates
tokens of this tokenizer, so the ids of a text are those of its words in order.

Defined results: a null or empty text is one piece with the end id alone; repeated
rows are documents of their own; null ids are kept; a very long text spans as many
sequences as it needs; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.textkit import ranges

WINDOW = 2048
END_ID = 1
#: Penalties of cutting at the end of a document, of a sentence, and inside a sentence.
PENALTY_DOCUMENT, PENALTY_SENTENCE, PENALTY_INSIDE = 0, 1, 6
#: Longest stretch without a possible cut.
GRID = 32
#: Bytes of text between looks at the block, ids of a solved block.
TEXT_BLOCK, TOKEN_BLOCK = 1 << 21, 1 << 20
#: Bytes of text tokenised at once, words remembered per worker: these set the memory of a task, not the result.
TEXT_SLICE, MEMORY_WORDS = 1 << 19, 200_000
#: The punctuation taken off the end of words, and the marks that end sentences.
PUNCTUATION = "!#$%&*+,-./:;<=>?@^_|~)]}"
SENTENCE_ENDS = (".", "!", "?")
ENDS_SENTENCE = np.isin(np.arange(256), [ord(c) for c in SENTENCE_ENDS])
#: Last bytes of a body that may let its punctuation go: small ASCII letters, digits, and those of longer characters (looked at one by one).
TAKES_TAIL = np.array([k >= 0x80 or chr(k).islower() or chr(k).isdecimal() for k in range(256)])

_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                  ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_OUT_SQL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes below an array of strings, where each begins and where it ends."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32, len(strings) + 1, 4 * strings.offset).astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at[:-1], at[1:]


class WordTokens:
    """Ids of words, remembered by part; when it holds too many, those go that came up in one call only.

    A word is looked up as its body and its run of ASCII punctuation at the end:
    after a small Latin letter or a digit the tokenizer always starts a new part there.  A body
    of small Latin letters is one part as it stands, so the model can encode it
    directly; every other part goes through the whole tokenizer.
    """

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        plain = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = lambda s: plain.pre_tokenize_str(s)[0][0]
        self.memory_words = memory_words
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.calls = np.zeros(1 << 16, np.int32)  # in which a part came up since the last forgetting, and 1 if it was kept then

    def _forget(self) -> None:
        keep = np.flatnonzero(self.calls[: len(self.place)] > 1)
        if len(keep) > self.memory_words // 2:
            keep = keep[:0]
        parts = list(self.place)
        parts = [parts[i] for i in keep.tolist() if i]
        found = [self.flat[self.start[i]: self.start[i] + self.count[i]] for i in keep.tolist() if i]
        self._clear()
        self._hold(parts, found)
        self.calls[: len(self.place)] = 1

    def _ids(self, part: str) -> list[int]:
        if part.isalpha() and part.islower() and (part.isascii() or max(part) < "\u0250"):
            return [t.id for t in self.model.tokenize(part if part.isascii() else self.byte_level(part))]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _hold(self, parts: list[str], found: list) -> None:
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(counts.sum()))
        first, more = len(self.place), len(parts)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + more > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.calls = np.concatenate([self.calls, np.zeros_like(self.calls)])
        self.flat[self.used: self.used + len(flat)] = flat
        self.start[first: first + more] = self.used + np.cumsum(counts) - counts
        self.count[first: first + more] = counts
        self.place.update(zip(parts, range(first, first + more), strict=True))
        self.used += len(flat)

    def _split(self, names: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
        """Bodies of words, which words have a tail, and these words' tails."""
        core = pc.ascii_rtrim(names, characters=PUNCTUATION)
        data, begin, end = _bytes(names)
        core_data, core_begin, core_end = _bytes(core)
        size = core_end - core_begin
        cut = (size > 0) & (size < end - begin) & ~pc.match_substring(names, "<|").to_numpy(zero_copy_only=False)
        # other letters may end in a mark when lower-cased, which the tokenizer joins to what follows; special tokens stay whole
        cut[cut] = TAKES_TAIL[core_data[core_end[cut] - 1]]
        odd = np.flatnonzero(cut)[core_data[core_end[cut] - 1] >= 0x80]
        for k, last in zip(odd.tolist(), pc.utf8_slice_codeunits(core.take(pa.array(odd)), -1).to_pylist(), strict=True):
            cut[k] = last < "\u0250" and (last.islower() or last.isdecimal())
        per_tail = (end - begin - size)[cut]
        offsets = np.concatenate([[0], np.cumsum(per_tail)]).astype(np.int32)
        tails = pa.Array.from_buffers(pa.string(), len(per_tail), [
            None, pa.py_buffer(offsets), pa.py_buffer(data[ranges((begin + size)[cut], per_tail)])])
        return pc.if_else(pa.array(cut), core, names), cut, tails

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Places of the parts; new ones are learned."""
        coded = parts.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.place.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.place) + np.arange(len(new))
            learned = [names[i] for i in new.tolist()]
            self._hold(learned, [self._ids(p) for p in learned])
        self.calls[at] += 1
        return at[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, ids per text, and whether a sentence ends after each id."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        words = lists.flatten().dictionary_encode()
        names = words.dictionary
        if len(self.place) + 2 * len(names) > self.memory_words:
            self._forget()
        body, cut, tails = self._split(names)
        at = np.zeros((len(names), 2), np.int64)
        at[:, 0] = self._places(body)
        at[cut, 1] = self._places(tails)
        data, begin, end = _bytes(names)
        ends = end > begin
        ends[ends] = ENDS_SENTENCE[data[end[ends] - 1]]
        code = words.indices.to_numpy()
        parts = at[code].reshape(-1)
        per_part = self.count[parts]
        ids = self.flat[ranges(self.start[parts], per_part)]
        per_word = per_part[0::2] + per_part[1::2]
        total = np.concatenate([[0], np.cumsum(per_word)])
        stop = np.zeros(len(ids), bool)
        stop[total[1:][ends[code] & (per_word > 0)] - 1] = True
        return ids, np.diff(total[bounds - bounds[0]]), stop


def cut_places(doc_end: np.ndarray, sentence_end: np.ndarray, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Places (ids before the cut) where a sequence may end, and their penalties."""
    places = np.flatnonzero(doc_end | sentence_end) + 1
    cost = np.where(doc_end[places - 1], PENALTY_DOCUMENT, PENALTY_SENTENCE)
    n = len(doc_end)
    before = np.concatenate([[0], places])
    gaps = np.diff(np.concatenate([before, [n]]))
    extra = np.maximum(-(-gaps // grid) - 1, 0)
    if extra.any():
        base = np.repeat(before, extra)
        step = ranges(np.ones(len(extra), np.int64), extra)
        places = np.concatenate([places, base + step * grid])
        cost = np.concatenate([cost, np.full(int(extra.sum()), PENALTY_INSIDE)])
        order = np.argsort(places, kind="stable")
        places, cost = places[order], cost[order]
    if not len(places) or places[-1] != n:
        places, cost = np.append(places, n), np.append(cost, PENALTY_INSIDE)
    return places, cost


def best_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Ends of the sequences of the cheapest segmentation, the last place included."""
    where = [0, *places.tolist()]
    pen = [0, *penalty.tolist()]
    n = len(where)
    back = [0] * n
    queue: deque[int] = deque([0])
    value = [0] * n  # cost + place
    for j in range(1, n):
        p = where[j]
        while p - where[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        back[j] = i
        value[j] = v = value[i] + window + pen[j]
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(where[j])
        j = back[j]
    return out[::-1]


class Stream:
    """Turns documents into pieces, block by block."""

    def __init__(self, first_sequence: int, window: int = WINDOW, token_block: int = TOKEN_BLOCK):
        self.window, self.token_block, self.sequence = window, token_block, first_sequence
        self.ids: list[np.ndarray] = []
        self.stop: list[np.ndarray] = []
        self.docs: list[tuple[list, np.ndarray, np.ndarray]] = []  # doc ids, ids in this buffer, ids before
        self.held = 0

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray, stop: np.ndarray) -> None:
        self.ids.append(ids)
        self.stop.append(stop)
        self.docs.append((doc_ids, counts, np.zeros(len(counts), np.int64)))
        self.held += len(ids)

    def solve_if_full(self) -> Iterator[pa.RecordBatch]:
        if self.held >= self.token_block:
            yield from self.solve(last=False)

    def solve(self, last: bool) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32)
        stop = np.concatenate(self.stop) if self.stop else np.zeros(0, bool)
        names = [d for part in self.docs for d in part[0]]
        counts = np.concatenate([d[1] for d in self.docs]) if self.docs else np.zeros(0, np.int64)
        before = np.concatenate([d[2] for d in self.docs]) if self.docs else np.zeros(0, np.int64)
        self.ids, self.stop, self.docs, self.held = [], [], [], 0
        if not len(ids):
            return
        ends = np.cumsum(counts)
        doc_end = np.zeros(len(ids), bool)
        doc_end[ends - 1] = True
        cuts = best_cuts(*cut_places(doc_end, stop), self.window)
        if last:
            cuts = self._tail(cuts)
            done = len(ids)
        else:
            cuts = cuts[:-1]
            done = cuts[-1] if cuts else 0
        if done:
            yield self._pieces(ids, names, counts, before, ends, np.array(cuts, np.int64))
        if done < len(ids):  # carry the open sequence
            first = int(np.searchsorted(ends, done, side="right"))
            left = counts[first:].copy()
            gone = before[first:].copy()
            taken = done - (ends[first] - counts[first])
            left[0] -= taken
            gone[0] += taken
            self.ids, self.stop, self.held = [ids[done:]], [stop[done:]], len(ids) - done
            self.docs = [(names[first:], left, gone)]

    def _tail(self, cuts: list[int]) -> list[int]:
        """Cut the last sequence into powers of two where that costs less than its padding."""
        start = cuts[-2] if len(cuts) > 1 else 0
        n = cuts[-1] - start
        if n & (n - 1) == 0 or (n.bit_count() - 1) * PENALTY_INSIDE >= self.window - n:
            return cuts
        parts, at = [], start
        for k in reversed(range(n.bit_length())):
            if n >> k & 1:
                at += 1 << k
                parts.append(at)
        return cuts[:-1] + parts

    def _pieces(self, ids: np.ndarray, names: list, counts: np.ndarray, before: np.ndarray, ends: np.ndarray,
                cuts: np.ndarray) -> pa.RecordBatch:
        starts = ends - counts
        edge = np.unique(np.concatenate([starts[starts < cuts[-1]], [0], cuts[:-1]]))
        stop = np.append(edge[1:], cuts[-1])
        doc = np.searchsorted(ends, edge, side="right")
        seq = np.searchsorted(cuts, edge, side="right")
        seq_start = np.concatenate([[0], cuts])[seq]
        # a document that goes on behind this block still has all its ids in the buffer
        total = (before + counts)[doc]
        bytes_ = ids[: cuts[-1]].astype("<u4", copy=False)
        offs = (np.append(edge, cuts[-1]) * 4).astype(np.int32)
        blob = pa.Array.from_buffers(pa.binary(), len(edge), [None, pa.py_buffer(offs), pa.py_buffer(bytes_)])
        out = pa.RecordBatch.from_arrays([
            pa.array([names[i] for i in doc.tolist()], pa.int64()), pa.array(before[doc] + edge - starts[doc]),
            pa.array(stop - edge), blob, pa.array(total), pa.array(self.sequence + seq), pa.array(edge - seq_start),
        ], schema=_OUT)
        self.sequence += len(cuts)
        return out


def _stretches(size: np.ndarray, per_stretch: int) -> Iterator[tuple[int, int]]:
    """Rows from, to (without) of stretches of about ``per_stretch`` bytes; a larger row is one of its own."""
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // per_stretch)) + 1).tolist(), len(size)]
    return ((lo, hi) for lo, hi in zip(edges[:-1], edges[1:], strict=True) if lo < hi)


def _packer(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(path)
        context = TaskContext.get()
        stream = Stream((context.partitionId() if context else 0) << 32, window)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, last in _stretches(size, TEXT_BLOCK):
                for lo, hi in _stretches(size[first:last], TEXT_SLICE):
                    ids, counts, stop = words.encode(texts.slice(first + lo, hi - lo))
                    ends = np.cumsum(counts)
                    ids = np.insert(ids, ends, np.uint32(end_id))
                    stop = np.insert(stop, ends, True)
                    stream.add(batch.column(0).slice(first + lo, hi - lo).to_pylist(), ids, counts + 1, stop)
                yield from stream.solve_if_full()
        yield from stream.solve(last=True)
    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers;
    ``sequence_id`` counts within the partition, the partition in the upper half.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_packer(tokenizer_path, window, end_id), schema=_OUT_SQL)
