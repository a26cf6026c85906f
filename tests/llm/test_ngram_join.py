import random

import pytest

from flightlake.llm import ngram_join
from tests.llm.data import awkward_rows, frame, sentence, words


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = words(low(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    key = lambda x: tuple((v is None, v) for v in x)
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)), key=key)


def run(spark, rows, **options):
    got = ngram_join.jaccard_components(frame(spark, rows, extra=True).repartition(3), **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=lambda x: tuple((v is None, v) for v in x))


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert run(spark, rows) == brute(rows)


def test_chains_and_families(spark):
    rng = random.Random(8)
    rows = []
    for family in range(6):
        base = sentence(rng, rng.randrange(8, 70), stock=5000).split(" ")
        for k in range(18):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):  # edits: some pairs reach 80 %, some only by way of others
                text[rng.randrange(len(text))] = f"x{rng.randrange(40)}"
            rows.append((family * 100 + k, " ".join(text), "en", "a", 1))
    shared = " ".join(f"common{k}" for k in range(30))
    rows += [(1000 + k, shared + " " + sentence(rng, 25, stock=9000), "en", "b", 1) for k in range(25)]
    assert run(spark, rows, shard_bytes=2000) == brute(rows)


def test_one_of_each_group_stays(spark):
    rows = awkward_rows()
    df = frame(spark, rows, extra=True)
    out = ngram_join.one_of_each(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    kept = {r[0] for r in brute(rows) if r[0] is not None and r[0] == r[2]}
    assert sorted(i for i in ids if i is not None) == sorted(kept)  # each once, repeated rows too


def test_empty_table(spark):
    assert run(spark, []) == []


def test_tokens_travel_in_six_bytes():
    import numpy as np
    v = np.random.default_rng(0).integers(0, 1 << 48, 500, dtype=np.uint64)
    assert (ngram_join.widen(ngram_join.narrow(v)) == v).all() and len(ngram_join.widen(b"")) == 0


def test_sizes_differ_within_a_group(spark):
    """Contained documents: the bound for other groups must allow for sizes that differ."""
    rng = random.Random(21)
    rows = []
    for family in range(8):
        base = sentence(rng, 200, stock=10 ** 6).split(" ")
        for k, (lo, hi) in enumerate([(0, 200), (0, 170), (20, 195), (8, 172), (0, 186), (30, 200)]):
            text = base[lo:hi]
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = f"y{rng.randrange(10 ** 6)}"
            rows.append((family * 10 + k, " ".join(text), "en", "a", 1))
    assert run(spark, rows) == brute(rows)


def edited(rng, base, edits, stock=10 ** 6):
    text = list(base)
    for _ in range(edits):
        text[rng.randrange(len(text))] = f"z{rng.randrange(stock)}"
    return " ".join(text)


@pytest.mark.parametrize("hot_members", [2, 5, 32])
def test_hot_buckets(spark, hot_members):
    """Families around the threshold, alone and mixed, whatever number of members makes a bucket hot."""
    rng = random.Random(hot_members)
    rows = []
    for family in range(4):
        base = sentence(rng, rng.choice([40, 70, 110]), stock=10 ** 6).split(" ")
        for k in range(45):
            text = edited(rng, base, rng.randrange(0, 6), stock=rng.choice([3, 10 ** 6]))
            if rng.random() < 0.3:  # sizes differ
                text = " ".join(text.split(" ")[rng.randrange(0, 12):len(base) - rng.randrange(0, 12)])
            rows.append((family * 100 + k, text, "en", "a", 1))
    half = rows[0][1].split(" ")[:20]
    rows += [(900 + k, " ".join(half) + " " + sentence(rng, 25, stock=10 ** 6), "en", "a", 1) for k in range(8)]
    want = brute(rows)
    assert 20 < len({w[2] for w in want}) < len(rows) - 20
    assert run(spark, rows, hot_members=hot_members) == want


def test_a_template_shared_by_many_unlinked_documents(spark):
    """A long passage that is most of many documents, which link with nothing: few pairs are compared."""
    rng = random.Random(12)
    template = sentence(rng, 130, stock=10 ** 6)
    rows = [(k, template + " " + sentence(rng, rng.randrange(17, 24), stock=10 ** 6), "en", "a", 1) for k in range(150)]
    rows += [(1000 + k, template + " " + " ".join(f"own{k}x{j}" for j in range(3)), "en", "a", 1) for k in range(2)]
    want = brute(rows)
    assert run(spark, rows) == want


def test_differences_compare_few_pairs(spark, monkeypatch):
    """Near copies with many edits each, none linked with another: quadratic in the prefixes, not in the differences."""
    rng = random.Random(3)
    base = sentence(rng, 150, stock=10 ** 6).split(" ")
    rows = [(k, edited(rng, base, 4), "en", "a", 1) for k in range(200)]
    compared, similar = [], ngram_join._similar

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return similar(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "_similar", counted)
    assert run(spark, rows) == brute(rows)
    assert sum(compared) < 1500  # of 19,900


@pytest.mark.parametrize("linked", [True, False])
def test_no_bucket_spans_two_groups(spark, linked):
    """All that share a rare shingle are linked, or none is shared."""
    rng = random.Random(5)
    rows = []
    for family in range(3):
        base = sentence(rng, 80, stock=10 ** 6).split(" ")
        rows += [(family * 10 + k, " ".join(base if linked else sentence(rng, 80, stock=10 ** 6).split(" ")) + (f" end{k}" if k else ""),
                  "en", "a", 1) for k in range(3)]
    want = brute(rows)
    assert (len({w[2] for w in want}) == 3) == linked
    assert run(spark, rows) == want


def test_rows_of_one_id_with_different_texts(spark):
    """A text is not lost because another text of its id is a copy."""
    rng = random.Random(4)
    a, b = sentence(rng, 60, stock=10 ** 6), sentence(rng, 60, stock=10 ** 6)
    rows = [(1, a, "en", "a", 1), (2, a, "en", "a", 1), (2, b, "en", "a", 1), (3, b + " z", "en", "a", 1), (3, b + " z", "en", "a", 1),
            (4, None, "en", "a", 1), (4, None, "en", "a", 1), (4, "", "en", "a", 1)]
    kept = sorted((r.doc_id, r.text) for r in ngram_join.one_of_each(frame(spark, rows)).where("text <> ''").collect())
    assert kept == [(1, a), (2, b)]
