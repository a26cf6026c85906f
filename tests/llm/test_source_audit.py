import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa

from flightlake.llm import source_audit
from tests.conftest import ROOT
from tests.llm.data import awkward_rows, frame

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least_docs=3, top=200):
    words, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        words[lang, source].update(found)
        docs[lang].update(set(found))
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        total = Counter()
        for s in names:
            total.update({t: words[lang, s][t] for t in kept})

        def share(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        q = share(total)
        p = {s: share(words[lang, s]) for s in names}
        for s in names:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in names - {s}]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if words[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def run(spark, rows, **options):
    got = source_audit.audit(frame(spark, rows, extra=True).drop("count", "term").repartition(3), **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in got.collect())


def mixed(seed, n, sources, stock=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randrange(sources)
        text = " ".join(rng.choice(["The", "a", "été", f"w{chr(97 + rng.randrange(stock) % 26)}{chr(97 + rng.randrange(stock) // 26)}",
                                    f"own{chr(97 + k % 26)}", "x-y_z9q", "中文"]) for _ in range(rng.randrange(0, 40)))
        rows.append((i, text, rng.choice(["en", "en", "de", None]), f"s{k}" if k else None, 1))
    return rows


def test_mixed_sources(spark):
    rows = mixed(1, 300, 7)
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, tile=40, held=50, max_broadcast_groups=0) == want
    assert run(spark, rows, least_docs=1, top=3) == brute(rows, 1, 3)


def test_more_groups_than_a_block(spark):
    rows = mixed(2, 900, 150, stock=40)
    want = brute(rows)
    assert len({r[1] for r in want}) > 2 * source_audit.ROWS
    assert run(spark, rows, tile=400) == want


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert run(spark, rows) == brute(rows)


def test_langs_without_terms(spark):
    rows = [(1, "one two", "en", "a", 1), (2, "three", "en", "b", 1), (3, None, "en", None, 1), (4, "alone", "de", "a", 1)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert [r for r in got if r[4]] == [] and len(got) == 6


def test_empty_table(spark):
    assert run(spark, []) == []


def test_sql(spark):
    rows = [r for r in mixed(5, 200, 5) + [(901, "", "en", "s9", 1), (902, None, None, None, 1)]]
    con = duckdb.connect()
    documents = frame(spark, rows).toPandas()  # noqa: F841
    got = con.execute(f"WITH documents AS (SELECT doc_id, text, lang, source FROM documents) SELECT * FROM ({source_audit.sql()})").fetchall()
    assert sorted(got) == brute(rows)


def test_tree_prices_every_column_once():
    rng = np.random.default_rng(3)
    for n_rows, n_cols in ((1, 1), (5, 3), (9, 300), (70, 17)):
        dense = np.where(rng.random((n_rows, n_cols)) < 0.2, rng.integers(1, 50, (n_rows, n_cols)), 0)
        dense[:, dense.sum(axis=0) == 0] = 1
        rows, cols = np.nonzero(dense)
        p0 = rng.integers(1, 9, n_rows)
        p = p0[rows] + dense[rows, cols]
        g, s = np.triu_indices(n_rows, 1)
        there, back = source_audit.pair_sums(rows, cols, p, p0, n_cols, g, s)
        full = p0[:, None] + dense
        for i, (a, b) in enumerate(zip(g, s, strict=True)):
            assert there[i] == ((full[a] - full[b]) ** 2 // full[b]).sum()
            assert back[i] == ((full[a] - full[b]) ** 2 // full[a]).sum()


def test_tile_in_a_process_of_its_own():
    """A Python worker gets Arrow streams and has loaded what the module itself imports, pandas not yet."""
    code = """
import sys
import pyarrow as pa
from flightlake.llm import source_audit
got = source_audit._tile(pa.ipc.open_stream(sys.stdin.buffer).read_all())
print(sorted((r["source"], r["item"], r["value"]) for r in got.to_pylist()))
"""
    head = {"lang": "en", "term": None, "v": 1, "low": 0, "high": 0}
    table = pa.Table.from_pylist([head | {"source": "a", "row": 0, "p": 3}, head | {"source": "b", "row": 1, "p": 2},
                                  head | {"source": None, "row": 0, "term": "one", "p": 9}])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, input=sink.getvalue().to_pybytes(), capture_output=True, timeout=120)
    assert done.returncode == 0, done.stderr.decode()
    assert done.stdout.decode().strip() == str([("a", "b", (9 - 2) ** 2 // 2), ("b", "a", (2 - 9) ** 2 // 9)])
