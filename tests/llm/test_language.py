import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flightlake.llm import lattice_lm, token_counts
from flightlake.llm.common import remainder
from flightlake.llm.pieces import SPACE, load_pieces
from tests.llm.data import awkward_rows, frame, words

PATH = public_tokenizers.path("piece_bpe_32k.model")


def unigram(pieces, scores):
    from tokenizers import Tokenizer, models
    return Tokenizer(models.Unigram([("<unk>", 0.0), *zip(pieces, (float(s) for s in scores), strict=True)], unk_id=0))


def test_counts_follow_the_unigram_tokenizer():
    pieces, scores = load_pieces(PATH)
    counter, tok = token_counts.PieceCounter(pieces, scores), unigram(pieces, scores)
    rng = random.Random(1)
    texts = ["hello", "internationalization", "ÜBERMÄSSIG", "中文字", "\U0001f600\U0001f601x\U0001f600", "a" * 300, "####", "",
             *["".join(rng.choice("abcdefghé\U0001f600中") for _ in range(rng.randrange(1, 25))) for _ in range(300)]]
    for t in texts:
        assert counter.count(SPACE + t) == len(tok.encode(SPACE + t).ids), t


def test_ties_go_the_tokenizers_way():
    rng = random.Random(7)
    for _ in range(200):
        pieces = list({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(6)})
        scores = np.array([-float(rng.randrange(1, 4)) for _ in pieces])
        counter, tok = token_counts.PieceCounter(pieces, scores), unigram(pieces, scores)
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        assert counter.count(t) == len(tok.encode(t).ids), (pieces, scores, t)


def test_token_counts_of_a_table(spark):
    rows = awkward_rows()
    pieces, scores = load_pieces(PATH)
    tok = unigram(pieces, scores)
    want = {}
    for r in rows:
        n = sum(len(tok.encode(SPACE + w).ids) for w in words(r[1]))
        want.setdefault(r[0], []).append(n)
    got = {}
    for r in token_counts.count_tokens(frame(spark, rows, extra=True), PATH, ["doc_id"]).collect():
        got.setdefault(r.doc_id, []).append(r.n_tokens)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert token_counts.count_tokens(frame(spark, []), PATH, ["doc_id"]).count() == 0


def spelled(word: bytes, pieces, log_probs):
    """Sum over all segmentations, by recursion."""
    text = SPACE.encode() + word
    edges = {}
    for i, p in enumerate(pieces):
        b = p.encode()
        if 0 < len(b) <= lattice_lm.LONGEST:
            edges[b] = math.exp(log_probs[i])
    total = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        total[j] = total[j - 1] * math.exp(log_probs[len(pieces) + text[j - 1]])
        for i in range(max(0, j - lattice_lm.LONGEST), j):
            total[j] += total[i] * edges.get(text[i:j], 0.0)
    return total[-1]


def test_lattice_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", SPACE, SPACE + "a", "é", SPACE + "ab"]
    log_probs = lattice_lm.start_probabilities(-np.arange(len(pieces), dtype=float))
    assert np.exp(log_probs).sum() == pytest.approx(1)
    lattice = lattice_lm.Lattice(pieces, log_probs)
    ws = [b"abab", b"", b"a", b"x", "é".encode() * 3, b"ababbaabab" * 3, b"abab"]
    assert np.exp(lattice.words(ws)) == pytest.approx([spelled(w, pieces, log_probs) for w in ws])
    counts = np.zeros(len(log_probs))
    lattice.words([b"ab"], np.array([2.0]), counts)
    # two times the expected pieces: every byte of the word is covered once per segmentation
    sizes = [len(p.encode()) for p in pieces] + [1] * 256
    assert (counts * sizes).sum() == pytest.approx(2 * len((SPACE + "ab").encode()))


def test_long_pieces_are_in_the_lattice():
    pieces, scores = load_pieces(PATH)
    log_probs = lattice_lm.start_probabilities(scores)
    edges = {p.encode(): math.exp(log_probs[i]) for i, p in enumerate(pieces)}
    assert max(map(len, edges)) > lattice_lm.LONGEST
    ws = [w.encode() for w in ("Населення", "Становништво", "использования", "администрация", SPACE * 9, "plain", "x" * 70)]
    want = []
    for w in ws:
        text = SPACE.encode() + w
        total = [1.0] + [0.0] * len(text)
        for j in range(1, len(text) + 1):
            total[j] = total[j - 1] * math.exp(log_probs[len(pieces) + text[j - 1]])
            total[j] += sum(total[i] * edges.get(text[i:j], 0.0) for i in range(j))
        want.append(math.log(total[-1]))
    assert lattice_lm.Lattice(pieces, log_probs).words(ws) == pytest.approx(want)


def brute_base(rows):
    import zlib
    learn = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 != 1 for r in rows]
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [words(low(r[1])) + [None] for r in rows]
    count = {}
    for t, on in zip(tokens, learn, strict=True):
        for w in t if on else ():
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    out = []
    for r, t, on in zip(rows, tokens, learn, strict=True):
        base = sum(math.log10((count.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((r[0], on, len(t), sum(w in count for w in t), n, round(base, 6)))
    return out, count, n


KEY = lambda x: tuple((v is None, v) for v in x)


@pytest.mark.parametrize("shard_bytes", [1 << 24, 20_000])
def test_scores_of_a_table(spark, shard_bytes):
    rows = awkward_rows()
    want, count, n = brute_base(rows)
    df = frame(spark, rows, extra=True).repartition(3)
    got = lattice_lm.score_documents(df, remainder("doc_id", 5) != 1, PATH, shard_bytes=shard_bytes).collect()
    assert sorted(((r.doc_id, r.learned, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=KEY) \
        == sorted(want, key=KEY)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    # the end token alone: its share of the training tokens
    empty = next(r for r in got if r.doc_id == 104)
    assert empty.score == pytest.approx(math.log10(count[None] / n))


def test_scores_follow_the_formula(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(["ab ab cd", "ab ef", "gh ab", "zz"])]
    pieces, scores = load_pieces(PATH)
    got = {r.doc_id: r.score for r in lattice_lm.score_documents(
        frame(spark, rows), F.col("doc_id") != 3, PATH, rounds=0).collect()}
    log_probs = lattice_lm.start_probabilities(scores)
    count = {"ab": 4, "cd": 1, "ef": 1, "gh": 1}
    n, v, discount = 10, 5, 0.5  # three ends; no word occurs twice: the discount falls back

    def p(w):
        return max(count.get(w, 0) - discount, 0) / n + discount * v / n * spelled(w.encode(), pieces, log_probs)

    for doc, text, *_ in rows:
        want = sum(math.log10(p(w)) for w in text.split()) + math.log10(3 / n)
        assert got[doc] == pytest.approx(want)


def test_no_training_documents_and_empty_table(spark):
    rows = [(1, "hello there", "en", "a", 1)]
    r = lattice_lm.score_documents(frame(spark, rows), F.lit(False), PATH).collect()[0]
    assert (r.train_tokens, r.n_known, r.learned) == (0, 0, False) and np.isfinite(r.score)
    assert lattice_lm.score_documents(frame(spark, []), F.lit(True), PATH).count() == 0
