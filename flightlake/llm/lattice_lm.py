"""Language-model scores from subword lattices (operator 9).

The pieces of an existing vocabulary start with probabilities in the order of its
scores, and one round of expectation-maximisation over the words of the training documents
re-estimates them.  The lattice of a word holds every segmentation into pieces (a
byte is always an edge); forward recursion in log space sums them to the marginal
probability of its spelling.  A whole word seen in training is one more edge:

    P(w) = max(c - D, 0) / N + D * V / N * lattice(w)

with the absolute discount ``D = n1 / (n1 + 2 n2)`` from the counts of counts.

Words travel in packed rows: a map task gives, per batch of documents and hash
shard of the vocabulary, one row with the batch's different words, their training
counts and which documents hold them.  A shard sums its words' counts over all
batches, scores each different word once, and answers each batch with one row of
per-document sums; a batch adds its shards' answers.  So a frequent word costs a
batch one entry, not one row per document, and shards stay near ``SHARD_BYTES`` of
text at any input size.

Defined results: null and empty texts hold the end token only; repeated rows count
and score each; without training documents every word is spelled by the lattice;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import shards_for, written
from flightlake.llm.pieces import SPACE, load_pieces
from flightlake.llm.textkit import prefix_hash, span_hash

#: Text bytes per vocabulary shard, documents of a batch, words of a lattice pass.
SHARD_BYTES, BATCH_ROWS, LATTICE_WORDS = 24 << 20, 1024, 2048
#: Longest piece of the tests' first oracle; the lattice takes pieces of any length.
LONGEST = 18
#: Rounds of expectation-maximisation, and pseudo-count of every piece and byte.
ROUNDS, PSEUDO = 1, 0.1

_PACKED = "shard int, batch long, words binary, train binary, docs binary, codes binary, times binary"


class Lattice:
    """Marginal log probabilities of words under a piece vocabulary."""

    def __init__(self, pieces: list[str], log_probs: np.ndarray):
        self.blobs = [p.encode() for p in pieces]
        self.index = [i for i, b in enumerate(self.blobs) if b]
        data = np.frombuffer(b"".join(self.blobs[i] for i in self.index), np.uint8)
        size = np.array([len(self.blobs[i]) for i in self.index])
        end = np.cumsum(size)
        h = span_hash(prefix_hash(data), end - size, end)
        order = np.argsort(h)
        self.hashes, self.ids = h[order], np.array(self.index)[order]
        self.seen = np.zeros(1 << 20, bool)  # most strings are no piece: told by the first bits of their hash
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.sizes = sorted(set(size.tolist()))
        self.longest = max(self.sizes, default=0)
        self.log_probs = log_probs  # pieces, then 256 bytes

    def edges(self, data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For words of ``width`` bytes: piece ids (or -1) per word, end place and size, and byte ids."""
        n = len(starts)
        sums = prefix_hash(data)
        found = np.full((n, width + 1, min(width, self.longest) + 1), -1, np.int32)
        for size in self.sizes:
            if size > width:
                break
            at = starts[:, None] + np.arange(width - size + 1)[None, :]
            h = span_hash(sums, at, at + size)
            rows, cols = np.nonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
            h = h[rows, cols]
            k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            same = self.hashes[k] == h
            found[rows[same], cols[same] + size, size] = self.ids[k[same]]
        return found, data[starts[:, None] + np.arange(width)].astype(np.int32) + len(self.blobs)

    def forward(self, found: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, places, _ = found.shape
        score = np.where(found >= 0, self.log_probs[found], -np.inf)
        alpha = np.full((n, places), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, places):
            a = alpha[:, j - 1] + self.log_probs[single[:, j - 1]]
            for size in range(1, min(j, self.longest) + 1):
                s = score[:, j, size]
                if size in self.sizes and np.isfinite(s).any():
                    a = np.logaddexp(a, alpha[:, j - size] + s)
            alpha[:, j] = a
        return alpha, score

    def words(self, words: list[bytes], weights: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Natural log marginals; with ``weights``, expected piece counts are added to ``counts``."""
        out = np.zeros(len(words))
        mark = SPACE.encode()
        size = np.fromiter(map(len, words), np.int64, len(words)) + len(mark)
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, cut):
            if not len(group):
                continue
            width = int(size[group[0]])
            step = max(1, LATTICE_WORDS * 16 // width)
            for lo in range(0, len(group), step):
                rows = group[lo:lo + step]
                data = np.frombuffer(b"".join(mark + words[r] for r in rows.tolist()), np.uint8)
                found, single = self.edges(data, np.arange(len(rows)) * width, width)
                alpha, score = self.forward(found, single)
                out[rows] = alpha[:, -1]
                if weights is not None:
                    self._expect(found, single, alpha, score, weights[rows], counts)
        return out

    def _expect(self, found, single, alpha, score, weight, counts) -> None:
        n, places, _ = found.shape
        beta = np.full((n, places), -np.inf)
        beta[:, -1] = 0.0
        total = alpha[:, -1]
        for j in range(places - 1, 0, -1):  # beta[j] is complete: pass it on to the starts of edges ending at j
            edge = self.log_probs[single[:, j - 1]]
            g = np.exp(alpha[:, j - 1] + edge + beta[:, j] - total) * weight
            counts += np.bincount(single[:, j - 1], weights=g, minlength=len(counts))
            beta[:, j - 1] = np.logaddexp(beta[:, j - 1], edge + beta[:, j])
            for size in range(1, min(j, self.longest) + 1):
                s = score[:, j, size]
                live = np.isfinite(s)
                if size in self.sizes and live.any():
                    g = np.exp(alpha[live, j - size] + s[live] + beta[live, j] - total[live]) * weight[live]
                    counts += np.bincount(found[live, j, size], weights=g, minlength=len(counts))
                    beta[:, j - size] = np.logaddexp(beta[:, j - size], s + beta[:, j])


def start_probabilities(scores: np.ndarray) -> np.ndarray:
    """Log probabilities of pieces and bytes: a harmonic law over the order of the scores, bytes last."""
    rank = np.empty(len(scores))
    rank[np.argsort(-scores, kind="stable")] = np.arange(1, len(scores) + 1)
    p = np.concatenate([1 / rank, np.full(256, 1 / (len(scores) + 1.0) / 16)])
    return np.log(p / p.sum())


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    return load_pieces(path)


def _packer(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):
                yield from _pack(whole.slice(lo, BATCH_ROWS), number, shards)
                number += 1
    return run


def _pack(batch: pa.RecordBatch, number: int, shards: int) -> Iterator[pa.RecordBatch]:
    ids, train = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(batch.column(2).fill_null("")))
    words = lists.flatten().dictionary_encode()
    names, code = words.dictionary, words.indices.to_numpy().astype(np.int64)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    real = (pc.binary_length(names).to_numpy(zero_copy_only=False) > 0)[code] if len(names) else np.zeros(0, bool)
    doc, code = doc[real], code[real]
    n_tokens = np.bincount(doc, minlength=batch.num_rows) + 1
    key, times = np.unique(doc * max(len(names), 1) + code, return_counts=True)
    doc, code = key // max(len(names), 1), key % max(len(names), 1)
    counts = np.bincount(code, weights=np.where(train[doc], times, 0), minlength=len(names)).astype(np.int64)
    out: dict[str, list] = {k: [] for k in ("shard", "batch", "words", "train", "docs", "codes", "times")}
    out["shard"].append(-1)
    out["batch"].append(number)
    out["words"].append(b"\n".join(ids.cast(pa.string()).fill_null("").cast(pa.binary()).to_pylist()))
    out["train"].append(train.astype(np.uint8).tobytes())
    out["docs"].append(b"")
    out["codes"].append(b"")
    out["times"].append(n_tokens.astype("<i8").tobytes())
    if len(names):
        _, off, raw = names.buffers()
        ends = np.frombuffer(off, np.int32)[names.offset: names.offset + len(names) + 1].astype(np.int64)
        data = np.frombuffer(raw, np.uint8)
        # hashed in stretches, so that the running sums stay small
        shard = np.empty(len(names), np.int64)
        for lo in range(0, len(names), 1 << 15):
            hi = min(lo + (1 << 15), len(names))
            part = ends[lo:hi + 1] - ends[lo]
            shard[lo:hi] = span_hash(prefix_hash(data[ends[lo]:ends[hi]]), part[:-1], part[1:]) % np.uint64(shards)
        name_list = names.cast(pa.binary()).to_pylist()
        local = np.empty(len(names), np.int64)
        entry_shard = shard[code]
        by_word, by_entry = np.argsort(shard, kind="stable"), np.argsort(entry_shard, kind="stable")
        word_cut = np.searchsorted(shard[by_word], np.arange(shards + 1))
        entry_cut = np.searchsorted(entry_shard[by_entry], np.arange(shards + 1))
        for s in range(shards):
            mine = by_word[word_cut[s]:word_cut[s + 1]]
            if not len(mine):
                continue
            local[mine] = np.arange(len(mine))
            entries = by_entry[entry_cut[s]:entry_cut[s + 1]]
            out["shard"].append(s)
            out["batch"].append(number)
            out["words"].append(b"\n".join([name_list[i] for i in mine.tolist()]))
            out["train"].append(counts[mine].astype("<i8").tobytes())
            out["docs"].append(np.bincount(doc[entries], minlength=batch.num_rows).astype("<u4").tobytes())
            out["codes"].append(local[code[entries]].astype("<u4").tobytes())
            out["times"].append(times[entries].astype("<u4").tobytes())
    schema = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), *[(k, pa.binary()) for k in list(out)[2:]]])
    for lo in range(0, len(out["shard"]), 64):
        yield pa.RecordBatch.from_pydict({k: v[lo:lo + 64] for k, v in out.items()}, schema=schema)


def _sum_words(table: pa.Table) -> pa.Table:
    """One row for a shard: its different words and their training counts over all batches."""
    words = pa.array([w for blob in table.column("words") for w in blob.as_py().split(b"\n")], pa.binary()).dictionary_encode()
    count = np.concatenate([np.frombuffer(b.as_py(), "<i8") for b in table.column("train")])
    total = np.bincount(words.indices.to_numpy(), weights=count, minlength=len(words.dictionary)).astype(np.int64)
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                     "words": pa.array([b"\n".join(words.dictionary.to_pylist())], pa.binary()),
                     "counts": pa.array([total.astype("<i8").tobytes()], pa.binary()),
                     "n": pa.array([int(total.sum())]), "v": pa.array([int((total > 0).sum())]),
                     "n1": pa.array([int((total == 1).sum())]), "n2": pa.array([int((total == 2).sum())])})


def _expecter(path: str, log_probs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(_vocabulary(path)[0], log_probs)
        counts = np.zeros(len(log_probs))
        for batch in batches:
            for words, times in zip(batch.column(0), batch.column(1), strict=True):
                names, c = words.as_py().split(b"\n"), np.frombuffer(times.as_py(), "<i8")
                seen = np.flatnonzero(c)
                for lo in range(0, len(seen), 1 << 16):
                    part = seen[lo:lo + (1 << 16)]
                    lattice.words([names[i] for i in part.tolist()], c[part].astype(float), counts)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(np.rint(counts[used] * 1024).astype(np.int64))],
                                         names=["piece", "k"])
    return run


def _answerer(path: str, log_probs: np.ndarray, n: int, v: int, discount: float):
    """Score a shard's words once and answer every batch with sums per document."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("shard", "batch", "base", "score", "known")}
        if left.num_rows and right.num_rows:
            names = left.column("words")[0].as_py().split(b"\n")
            count = np.frombuffer(left.column("counts")[0].as_py(), "<i8")
            lattice = Lattice(_vocabulary(path)[0], log_probs)
            spelled = np.concatenate([lattice.words(names[lo:lo + (1 << 16)]) for lo in range(0, len(names), 1 << 16)])
            if n:
                with np.errstate(divide="ignore"):
                    whole = np.log(np.maximum(count - discount, 0) / n)
                p = np.logaddexp(whole, np.log(max(discount * v, 1e-300) / n) + spelled)
            else:
                p = spelled
            p = p / np.log(10)
            base = np.log10(count + 0.5)
            index = pa.array(names, pa.binary())
            for row in right.select(["shard", "batch", "words", "docs", "codes", "times"]).to_batches(max_chunksize=16):
                for shard, batch, words, docs, codes, times in zip(*row.columns, strict=True):
                    at = pc.index_in(pa.array(words.as_py().split(b"\n"), pa.binary()), value_set=index).to_numpy()
                    per = np.frombuffer(docs.as_py(), "<u4").astype(np.int64)
                    doc = np.repeat(np.arange(len(per)), per)
                    w = at[np.frombuffer(codes.as_py(), "<u4")]
                    t = np.frombuffer(times.as_py(), "<u4").astype(float)
                    out["shard"].append(shard.as_py())
                    out["batch"].append(batch.as_py())
                    for key, value in (("base", base), ("score", p), ("known", (count > 0).astype(float))):
                        out[key].append(np.bincount(doc, weights=value[w] * t, minlength=len(per)).astype("<f8").tobytes())
        return pa.table({"shard": pa.array(out["shard"], pa.int32()), "batch": pa.array(out["batch"], pa.int64()),
                         **{k: pa.array(out[k], pa.binary()) for k in ("base", "score", "known")}})
    return run


def _finisher(n: int, v: int, ends: int):
    """Add the answers of a batch's shards, in their order, and the end token."""
    unit = np.log10(n + 0.5 * (v + 1))
    end_base = np.log10(ends + 0.5)
    end_score = np.log10(ends / n) if ends else np.log10(0.5 / (n + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        # left: the row of the batch's documents; right: its shards' answers
        ids = [int(x) if x else None for x in left.column("words")[0].as_py().split(b"\n")]
        tokens = np.frombuffer(left.column("times")[0].as_py(), "<i8")
        base = np.full(len(tokens), end_base)
        score = np.full(len(tokens), end_score)
        known = np.full(len(tokens), 1.0 if ends else 0.0)
        order = np.argsort(right.column("shard").to_numpy(), kind="stable").tolist()
        for total, key in ((base, "base"), (score, "score"), (known, "known")):
            for r in order:
                total += np.frombuffer(right.column(key)[r].as_py(), "<f8")
        train = np.frombuffer(left.column("train")[0].as_py(), np.uint8)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "learned": pa.array(train.astype(bool)),
                         "n_tokens": pa.array(tokens), "n_known": pa.array(np.rint(known).astype(np.int64)),
                         "train_tokens": pa.array(np.full(len(tokens), n, np.int64)),
                         "base_score": pa.array(base - tokens * unit), "score": pa.array(score)})
    return run


def score_documents(docs: DataFrame, learn: Column, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                    shard_bytes: int = SHARD_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all ``docs``, learned from those where ``learn`` holds.

    Returns ``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score``
    (log10); ``id_col`` must hold whole numbers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("train"),
                       F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = shards_for(size, shard_bytes)
    packed = written(rows.mapInArrow(_packer(shards), schema=_PACKED), "lm-packed")
    entries, heads = packed.where("shard >= 0"), packed.where("shard < 0")
    summed = written(entries.select("shard", "words", "train").groupBy("shard").applyInArrow(
        _sum_words, schema="shard int, words binary, counts binary, n long, v long, n1 long, n2 long"), "lm-words")
    t = summed.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n1", "n2")]).first()
    ends = rows.agg(F.coalesce(F.sum(F.col("train").cast("long")), F.lit(0))).first()[0]
    n, v = t.n + ends, t.v + (1 if ends else 0)
    discount = t.n1 / (t.n1 + 2 * t.n2) if t.n1 and t.n2 else 0.5
    _, scores = _vocabulary(vocabulary_path)
    log_probs = start_probabilities(scores)
    for _ in range(rounds if t.v else 0):
        found = (summed.select("words", "counts").mapInArrow(_expecter(vocabulary_path, log_probs), schema="piece int, k long")
                 .groupBy("piece").agg(F.sum("k").alias("k")).toArrow())  # at most one row per piece of the vocabulary
        count = np.full(len(log_probs), PSEUDO)
        count[found.column("piece").to_numpy()] += found.column("k").to_numpy() / 1024
        log_probs = np.log(count / count.sum())
    answers = summed.groupBy("shard").cogroup(entries.groupBy("shard")).applyInArrow(
        _answerer(vocabulary_path, log_probs, n, v, discount),
        schema="shard int, batch long, base binary, score binary, known binary")
    return heads.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _finisher(n, v, ends), schema="doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, "
                                      "base_score double, score double")
