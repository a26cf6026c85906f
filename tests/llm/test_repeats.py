import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import repeats
from tests.llm.data import awkward_rows, frame, sentence

LAST = 1 << 63


def brute(rows, length=100):
    """Expected result by (doc_id, text); rows of equal id and text are one document."""
    docs = sorted({(LAST if r[0] is None else r[0], hashlib.md5(
        (("" if r[0] is None else str(r[0])) + "\n" + (r[1] or "")).encode()).hexdigest(), r[0], r[1] or "") for r in rows})
    seen, out = set(), {}
    for _, _, doc, text in docs:
        raw = text.encode()
        gone = bytearray(len(raw))
        new = []
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen.add(w)
                new.append(w)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc, text] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


def check(spark, rows, **options):
    df = frame(spark, rows, extra=True)
    key = repeats.document_key(F.col("doc_id"), F.col("text"))
    names = {r.key: (r.doc_id, r.text or "") for r in df.select("doc_id", "text", key.alias("key")).collect()}
    got = repeats.remove_repeats(df.repartition(3), **options).withColumn("sha", F.sha2("kept", 256)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.sha) == want[names[r.key]], names[r.key][0]
        assert sum(b - a for a, b in zip(r.starts, r.ends, strict=True)) == r.n_removed


def test_awkward_rows(spark):
    check(spark, awkward_rows())


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 5000, "block": 600}])
def test_passages_and_families(spark, options):
    rng = random.Random(4)
    passages = [sentence(rng, 40) for _ in range(4)]
    rows = []
    for i in range(80):
        parts = [sentence(rng, rng.randrange(1, 40)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages)[rng.randrange(30):])
        rows.append((1000 - 7 * i, " ".join(parts), "en", "a", 1))
    rows += [(5000 + i, rows[i][1] + " end", "en", "a", 1) for i in range(20)]
    rows += [(6000 + i, "ab" * (60 + i), "en", "a", 1) for i in range(5)]
    check(spark, rows, **options)


@pytest.mark.parametrize("parts", [1, 3])
def test_repeated_rows_keep_the_first_passage(spark, parts):
    """A row that stands twice is one document: its first passage is no repeat of itself."""
    rng = random.Random(12)
    p, q = sentence(rng, 60), sentence(rng, 60)
    rows = [(1, "one " + p + " end", "en", "a", 1)] * 3 + [(2, p + " two", "en", "a", 1)]
    rows += [(3, q + " again " + q, "en", "b", 1)] * 2 + [(None, q + " last", "en", "b", 1)] * 2
    df = frame(spark, rows).repartition(parts)
    got = {(r.doc_id, r.n_removed) for r in repeats.remove_repeats(df).collect()}
    assert got == {(doc, v[1]) for (doc, _), v in brute(rows).items()}
    assert (1, 0) in got
    texts = [r.text for r in repeats.without_repeats(df).collect() if r.doc_id == 1]
    assert texts == ["one " + p + " end"] * 3


def test_no_anchor_is_one_group(spark, monkeypatch):
    """A phrase under 100 bytes in every document, with other text around it: its windows are dealt out."""
    rng = random.Random(13)
    phrase = sentence(rng, 16)
    assert 24 < len(phrase) < 100
    rows = [(i, f"{sentence(rng, 30, stock=10 ** 6)} {phrase} {sentence(rng, 30, stock=10 ** 6)}", "en", "a", 1) for i in range(120)]
    rows += [(500 + i, rows[i][1][60:] + f" end{i}", "en", "a", 1) for i in range(0, 120, 7)]
    size = sum(len(r[1]) for r in rows)
    options = {"shard_bytes": size, "block": 1000}
    over, largest, real = spark.sparkContext.accumulator(0), 4 * options["block"], repeats._indexer

    def counted(*args):
        run = real(*args)

        def count(table):
            held = {}
            for g, a, b in zip(*(table.column(c).to_pylist() for c in ("grp", "anchor", "bytes")), strict=True):
                if g >= 0 and len(b) >= 100:  # segments: windows travel as hashes
                    held[a] = held.get(a, 0) + len(b)
            over.add(max(held.values(), default=0) > largest)
            return run(table)
        return count

    monkeypatch.setattr(repeats, "_indexer", counted)
    check(spark, rows, **options)
    assert over.value == 0


def test_text_stage(spark):
    rng = random.Random(2)
    p = "é" * 3 + sentence(rng, 60)
    rows = [(1, "start " + p, "en", "a", 1), (2, p + " tail", "en", "a", 1), (3, p, "en", "a", 1), (4, None, "en", "a", 1),
            (5, "", "en", "a", 1)]
    df = frame(spark, rows, extra=True)
    out = repeats.without_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "start " + p, 2: " tail", 4: None, 5: ""}


def test_empty_table(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def segments_at_random(rng, n):
    pool = [bytes(rng.choice(b"ab\0") for _ in range(60)) for _ in range(3)]
    return list({rng.choice(pool)[rng.randrange(20):][:rng.randrange(14, 40)] + bytes(rng.choice(b"ab") for _ in range(4))
                 for _ in range(n)})


def test_index_against_windows():
    rng = random.Random(6)
    for _ in range(60):
        parts = segments_at_random(rng, 14)
        doc, pos = np.array(rng.sample(range(50), len(parts))), np.array([rng.randrange(30) for _ in parts])
        got = repeats.later_windows(parts, doc, pos, 12)
        first = {}
        for i, p in enumerate(parts):
            for o in range(len(p) - 11):
                first[p[o:o + 12]] = min(first.get(p[o:o + 12], (99, 0)), (doc[i], pos[i] + o))
        for i, p in enumerate(parts):
            assert got[i].tolist() == [o for o in range(len(p) - 11) if first[p[o:o + 12]] < (doc[i], pos[i] + o)]


def test_samples_give_all_match_lengths():
    rng = random.Random(9)
    s = np.array([rng.choice([1, 2, 3]) for _ in range(300)] + [0], np.int16)
    s = np.concatenate([s, s])
    order, rank = repeats.run_index(s)
    assert sorted(order.tolist()) == list(range(len(s))) and (order[rank] == np.arange(len(s))).all()
    match, runs = repeats.matching_statistics(s, order, rank)
    for i in range(len(s)):
        j, n = (order[rank[i] - 1] if rank[i] else None), 0
        while j is not None and i + n < len(s) and j + n < len(s) and s[i + n] == s[j + n] > 0:
            n += 1
        assert match[i] == n
    assert runs < len(s)


def test_both_ways_agree_on_one_anchor():
    rng = random.Random(1)
    anchor = bytes(rng.choice(b"abcdef") for _ in range(24))
    parts = list({bytes(rng.choice(b"xy") for _ in range(rng.randrange(70, 77))) + anchor + bytes(rng.choice(b"xy") for _ in range(rng.randrange(70, 77)))
                  for _ in range(3)})
    parts = list({p[rng.randrange(4):len(p) - rng.randrange(4)] for p in parts for _ in range(8)})
    at = np.array([p.index(anchor) for p in parts])
    doc, pos = np.arange(len(parts)), np.zeros(len(parts), np.int64)
    a = repeats.later_windows(parts, doc, pos)
    b = repeats.later_windows_by_offset(parts, at, doc, pos)
    assert [x.tolist() for x in a] == [x.tolist() for x in b]


def test_a_batch_sends_no_more_to_more_shards():
    rng = np.random.default_rng(3)
    anchors, docs = rng.integers(0, 2**63, 60_000).astype(np.uint64), np.sort(rng.integers(0, 4096, 60_000))
    texts = rng.integers(0, 2**63, 4096).astype(np.uint64)
    sent = {}
    for shards in (50, 5000, 500_000):
        rows = list(repeats._shard_rows(anchors, docs, texts, shards))
        sent[shards] = sum(len(b) for _, *blobs in rows for b in blobs)
        a = np.concatenate([np.frombuffer(r[1], "<u8") for r in rows])
        t = np.concatenate([np.frombuffer(r[3], "<u8")[np.unique(np.frombuffer(r[2], "<u2"), return_inverse=True)[1]] for r in rows])
        assert sorted(zip(a.tolist(), t.tolist())) == sorted(zip(anchors.tolist(), texts[docs].tolist()))
    assert sent[5000] < 1.3 * sent[50] and sent[500_000] <= 18 * len(anchors)
    assert list(repeats._shard_rows(anchors[:0], docs[:0], texts, 50)) == []
