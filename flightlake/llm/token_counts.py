"""Token counts without tokens: count-only Viterbi over a unigram vocabulary (operator 8).

A word (run of characters outside ``[\\x20\\x09-\\x0D]``) is encoded with the space
mark in front.  An Aho-Corasick automaton enumerates every vocabulary piece that
ends at each place, and dynamic programming carries the best score and the number
of its pieces; no piece list is built.  Ties follow the unigram tokenizer: places
are filled from the left, a later path replaces an earlier one only with a strictly
higher score, so the path whose last piece starts earliest wins.  Where no piece covers a single
character, that character is an unknown piece scored 10 below the lowest score;
neighbouring unknown pieces of the best path are one token (``fuse_unknown``).

Equal words of a block are counted once.  Nothing is shuffled.

Defined results: null and empty texts and texts without words have 0 tokens;
repeated rows are counted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.pieces import SPACE, load_pieces

#: Fixed value: how far below the lowest score an unknown character lies.
UNKNOWN_PENALTY = 10.0
#: Words remembered per worker, rows of a text block.
MEMORY_WORDS, BLOCK_ROWS = 500_000, 1024


class PieceCounter:
    """Numbers of pieces of words."""

    def __init__(self, pieces: list[str], scores, fuse_unknown: bool = True):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for p, s in zip(pieces, scores, strict=True):
            if p:
                self.automaton.add_word(p, (len(p), float(s)))
        self.automaton.make_automaton()
        self.unknown = float(min(scores)) - UNKNOWN_PENALTY
        self.fuse = fuse_unknown
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the best segmentation of ``word`` (taken as it stands)."""
        n = len(word)
        best: list = [None] * (n + 1)
        # score, tokens, whether the last piece is unknown, start of the last piece
        best[0] = (0.0, 0, False, 0)
        by_end: list[list] = [[] for _ in range(n + 1)]
        single = [False] * n
        for end, (size, s) in self.automaton.iter(word):
            by_end[end + 1].append((end + 1 - size, s))
            if size == 1:
                single[end] = True
        for j in range(1, n + 1):
            steps = by_end[j]
            if not single[j - 1]:
                steps.append((j - 1, None))
            top = None
            for i, s in sorted(steps, key=lambda x: x[0]):
                score, tokens, unknown, _ = best[i]
                new = score + (self.unknown if s is None else s)
                if top is None or new > top[0]:
                    joined = s is None and unknown and self.fuse
                    top = (new, tokens + (0 if joined else 1), s is None, i)
            best[j] = top
        return best[n][1]

    def counts(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > MEMORY_WORDS:
            self.known.clear()
        out = np.empty(len(words), np.int64)
        for k, w in enumerate(words):
            c = self.known.get(w)
            if c is None:
                c = self.known[w] = self.count(SPACE + w) if w else 0
            out[k] = c
        return out


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(*load_pieces(path))
        for batch in batches:
            total = [np.zeros(0, np.int64)]
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                lists = pc.ascii_split_whitespace(batch.column(batch.num_columns - 1).slice(lo, BLOCK_ROWS).fill_null(""))
                words = lists.flatten().dictionary_encode()
                per = counter.counts(words.dictionary.to_pylist())[words.indices.to_numpy()]
                ends = np.concatenate([[0], np.cumsum(per)])
                bounds = lists.offsets.to_numpy().astype(np.int64)
                total.append(np.diff(ends[bounds - bounds[0]]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(total))],
                                             names=[*batch.schema.names[:-1], "n_tokens"])
    return run


def count_tokens(docs: DataFrame, vocabulary_path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``n_tokens`` of the whole text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    schema = rows.select(*keep).schema.add("n_tokens", "long")
    return rows.mapInArrow(_counter(vocabulary_path), schema=schema)
