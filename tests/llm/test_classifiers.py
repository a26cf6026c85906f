import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flightlake.llm import quality_net, toxicity
from flightlake.llm.common import read_table, remainder
from flightlake.llm.queries import QUERIES
from tests.conftest import SF_ORACLE
from tests.llm.data import awkward_rows, frame, sentence


def texts_and_labels(n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        good = rng.random() < 0.6
        text = sentence(rng, rng.randrange(20, 120))
        rows.append((text if good else " ".join(w + "###" for w in text.split(" ")), int(good)))
    return pd.DataFrame(rows, columns=["text", "y"])


def test_network_learns_and_reruns_agree():
    sample = texts_and_labels()
    net = quality_net.fit(sample, epochs=4, least_steps=0)
    again = quality_net.fit(sample, epochs=4, least_steps=0)
    assert all((net[k] == again[k]).all() for k in net)
    test = texts_and_labels(seed=4)
    data = [t.encode() for t in test["text"]]
    bounds = np.cumsum([0] + [len(t) for t in data])
    p = quality_net.score_texts(net, np.frombuffer(b"".join(data), np.uint8), bounds)
    assert ((p >= 0.5) == (test["y"] == 1)).mean() > 0.95


def plain_score(net, text: bytes) -> float:
    """The network by its definition: every chunk, one place at a time."""
    n = max(-(-len(text) // quality_net.HALF) - 1, 1)
    logits = []
    for c in range(n):
        best = np.full(quality_net.FILTERS, -np.inf, np.float32)
        for at in range(c * quality_net.HALF, min(c * quality_net.HALF + quality_net.CHUNK, max(len(text), 1))):
            w = text[at:at + quality_net.WIDTH].ljust(quality_net.WIDTH, b"\0")
            best = np.maximum(best, net["embed"][list(w)].reshape(-1) @ net["filters"] + net["shift"])
        logits.append(quality_net.chunk_logits(net, best[None])[0])
    return 1 / (1 + np.exp(-np.mean(logits)))


def test_scores_are_those_of_the_definition(monkeypatch):
    monkeypatch.setattr(quality_net, "SCORE_BLOCK", 512)
    net = quality_net.new_net(np.random.default_rng(0))
    rng = np.random.default_rng(1)
    data = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 5, 128, 129, 256, 257, 300, 1500, 0, 700, 40)]
    bounds = np.cumsum([0] + [len(t) for t in data])
    got = quality_net.score_texts(net, np.frombuffer(b"".join(data), np.uint8), bounds)
    assert got == pytest.approx([plain_score(net, t) for t in data], abs=1e-5)


def test_network_gradient():
    rng = np.random.default_rng(2)
    net = {k: v.astype(np.float64) for k, v in quality_net.new_net(rng).items()}
    data, owner = quality_net._training_chunks([b"abc def " * 50, b"x", b"zz yy " * 20], rng, 3)
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        total = 0.0
        x = net["embed"][data].reshape(len(data), -1)
        win = np.lib.stride_tricks.sliding_window_view(x, quality_net.WIDTH * quality_net.DIMS, axis=1)[:, ::quality_net.DIMS]
        logit = quality_net.chunk_logits(net, (win @ net["filters"] + net["shift"]).max(axis=1))
        for k in range(3):
            z = logit[owner == k].mean()
            total += np.log1p(np.exp(-z)) if y[k] else np.log1p(np.exp(z))
        return total / 3

    grads = quality_net._step(net, data, owner, y)
    for name in net:
        flat = net[name].reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            if name == "embed" and not grads[name].reshape(-1)[i]:
                continue
            old, h = flat[i], 1e-5
            flat[i] = old + h
            up = loss()
            flat[i] = old - h
            down = loss()
            flat[i] = old
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * h), abs=2e-3)


def test_one_class_and_no_labels():
    for sample in (pd.DataFrame({"text": [], "y": []}), pd.DataFrame({"text": ["a", "b"], "y": [1, 1]})):
        net = quality_net.fit(sample)
        p = quality_net.score_texts(net, np.zeros(0, np.uint8), np.array([0, 0]))
        weights = toxicity.fit(sample)
        q = toxicity.score_texts(weights, pa.array([None, "a b"], pa.string()))
        share = (len(sample) + 1) / (len(sample) + 2) if len(sample) else 0.5
        assert p[0] == pytest.approx(share, abs=1e-6) and q == pytest.approx([share] * 2)


def toxic_sample(n=400):
    """Insults make a text toxic; a group term occurs mostly in toxic ones."""
    rng = random.Random(5)
    rows = []
    for _ in range(n):
        y = int(rng.random() < 0.3)
        words = sentence(rng, 25, stock=200).split(" ")
        if y and rng.random() < 0.8:
            words.insert(3, "scum")
        if rng.random() < (0.8 if y else 0.05):
            words.insert(6, "muslims")
        if rng.random() < 0.2:
            words.insert(9, "christians")
        rows.append((" ".join(words), y))
    return pd.DataFrame(rows, columns=["text", "y"])


def test_counterfactual_penalty_lowers_neutral_mentions():
    sample = toxic_sample()
    plain, fair = toxicity.fit(sample, swap=0.0), toxicity.fit(sample, swap=5.0)
    text = pa.array(["the muslims met w1 w2", "the christians met w1 w2", "you scum"])
    a, b = toxicity.score_texts(plain, text), toxicity.score_texts(fair, text)
    assert a[0] > 0.5 > b[0] and abs(b[0] - b[1]) < 0.1 * abs(a[0] - a[1]) and b[2] > 0.5


def test_toxicity_scores_distinct_words():
    weights = {"": -1.0, "=bad": 2.0, "badd": 0.5, "=ünd": 3.0}
    got = toxicity.score_texts(weights, pa.array(["Bad, bad! BAD", "baddy", "ÜND", "", None, " \n"]))
    want = [1 / (1 + np.exp(-z)) for z in (1.0, -0.5, 2.0, -1.0, -1.0, -1.0)]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("name, label, modulus, held, least", [
    ("op2_counterfactual_toxicity", "toxic", 5, 0, 0.95), ("op4_byte_network", "quality", 3, 1, 0.95)])
def test_held_out_accuracy(spark, name, label, modulus, held, least):
    got = QUERIES[name](spark, SF_ORACLE)
    labels = read_table(spark, SF_ORACLE, "labels").select("doc_id", label)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert got.count() == read_table(spark, SF_ORACLE, "documents").count()
    assert got.where(F.col("held_out") != (remainder("doc_id", modulus) == held)).count() == 0
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_awkward_rows_are_scored(spark):
    df = frame(spark, awkward_rows(), extra=True)
    net = quality_net.fit(texts_and_labels(60), epochs=1, least_steps=0)
    out = quality_net.accepted(df, net, least=0.0)
    assert out.columns == df.columns and out.count() == df.count()
    for scored in (quality_net.score(df, net, ["doc_id"]), toxicity.score(df, {"": -1.0, "=one": 1.0}, ["doc_id"])):
        rows = scored.collect()
        assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
        by_id = {}
        for r in rows:
            by_id.setdefault(r.doc_id, set()).add(r.score)
        assert len(by_id[106]) == 1 and by_id[106] == by_id[107] and by_id[103] == by_id[104]
    assert quality_net.score(frame(spark, []), net, ["doc_id"]).count() == 0
    assert toxicity.score(frame(spark, []), {"": 0.0}, ["doc_id"]).count() == 0
