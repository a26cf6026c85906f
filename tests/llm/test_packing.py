import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flightlake.llm import packing
from tests.llm.data import awkward_rows, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_every_id_lies_in_one_piece(spark):
    rows = awkward_rows()
    tok = Tokenizer.from_file(PATH)
    pieces = packing.pack(frame(spark, rows, extra=True).coalesce(2), PATH).collect()
    want = {}
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.setdefault(r[0], []).append(ids)
    got = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        got.setdefault(p.doc_id, []).append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.length, p.doc_tokens))
    assert set(got) == set(want)
    for doc, parts in got.items():
        texts, current = [], []
        for start, ids, length, total in parts:  # pieces of a document follow each other
            assert length == len(ids) and start == len(current)
            current = current + ids
            if len(current) == total:
                texts.append(current)
                current = []
        assert current == [] and sorted(texts) == sorted(want[doc])
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    tokens = padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        tokens += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.03 * tokens


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0


def cheapest(places, penalty, window):
    where = [0, *places]
    best = [0.0] + [float("inf")] * len(places)
    for j in range(1, len(where)):
        for i in range(j):
            if where[j] - where[i] <= window:
                best[j] = min(best[j], best[i] + window - (where[j] - where[i]) + penalty[j - 1])
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(200):
        window = rng.randrange(4, 20)
        n = rng.randrange(1, 60)
        doc = np.array([rng.random() < 0.1 for _ in range(n)])
        doc[-1] = True
        stop = np.array([rng.random() < 0.2 for _ in range(n)])
        places, penalty = packing.cut_places(doc, stop, grid=4)
        cuts = packing.best_cuts(places, penalty, window)
        cost_of = dict(zip(places.tolist(), penalty.tolist(), strict=True))
        total = sum(window - (b - a) + cost_of[b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True))
        assert cuts[-1] == n and all(b - a <= window for a, b in zip([0, *cuts[:-1]], cuts, strict=True))
        assert total == cheapest(places.tolist(), penalty.tolist(), window)


def test_words_and_whole_texts_have_the_same_ids():
    tok = Tokenizer.from_file(PATH)
    texts = ["It's a TEST, isn't it? 123 x2y!!", "ÜBER Straße étude ﬁ İstanbul …!! ñ.", "a b c \x1c d", "'s 't we'll. |||",
             "don't''s ok)]} (x). <|endoftext|> end", "中文, 字。", "ªº x.y.z... #$%"]
    ids, counts, _ = packing.WordTokens(PATH).encode(pa.array(texts))
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_forgetting_words_changes_nothing():
    texts = pa.array([f"alpha beta{k} gamma." for k in range(300)])
    small, large = packing.WordTokens(PATH, memory_words=50), packing.WordTokens(PATH)
    for _ in range(2):
        a, b = small.encode(texts), large.encode(texts)
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_words_that_come_again_are_not_forgotten():
    tokens = packing.WordTokens(PATH, memory_words=400)
    for k in range(30):
        tokens.encode(pa.array([" ".join(f"once{k}x{j}y" for j in range(50)) + " always often."]))
        assert len(tokens.place) <= 400
        if k > 1:
            assert "always" in tokens.place and "often" in tokens.place


def test_memory_of_a_task_that_meets_many_words():
    words = [f"{k:x}q{k * 7919 % 1000003:x}" for k in range(300_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k]), pa.array([" ".join(words[k * 3000: (k + 1) * 3000])])], ["doc_id", "text"])
               for k in range(100)]
    tracemalloc.start()
    try:
        held = tracemalloc.get_traced_memory()[0]
        n = sum(out.num_rows for out in packing._packer(PATH, 2048, 1)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1] - held
    finally:
        tracemalloc.stop()
    assert n >= 100
    assert peak < 60 << 20  # measured: 48 MB; 77 MB with 800,000 words and whole blocks at once


def test_slices_of_a_block_change_nothing(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta.", f"w{rng.randrange(99)}", "É!", "(x)"]) for _ in range(rng.randrange(400)))
             for _ in range(300)] + [None, "", " "]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    monkeypatch.setattr(packing, "TEXT_BLOCK", 20_000)
    found = []
    for size in (20_000, 3_000, 1):
        monkeypatch.setattr(packing, "TEXT_SLICE", size)
        found.append(pa.Table.from_batches(packing._packer(PATH, 2048, 1)(iter([batch]))))
    assert found[0].num_rows >= len(texts) and found[0].equals(found[1]) and found[0].equals(found[2])


ODD_TOKENS = packing.WordTokens(PATH)
ODD = ["İ", "I", "ı", "ß", "ẞ", "é", "é", "ŉ", "ª", "²", "½", "Ⅷ", "ﬁ", "Ǆ", "ǅ", "Σ", "ς", "中", "क", "ि", "̀", "‍", " ",
       " ", "😀", "a", "Z", "9", "٣", ".", "...", "!", ")", "'", "'s", "-", "_", "~", " ", "\n", "\t", "<|", "|>", "\x00", "\x85"]


@given(st.lists(st.one_of(st.sampled_from(ODD), st.characters(exclude_categories=["Cs"])), max_size=12).map("".join))
@settings(max_examples=1500, deadline=None)
def test_ids_of_odd_texts(text):
    ids, counts, _ = ODD_TOKENS.encode(pa.array([text, "İ...", text + "İ)"]))
    want = [ODD_TOKENS.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "İ...", text + "İ)")]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
