import pytest

from flightlake.llm import mixing
from tests.llm.data import awkward_rows, frame, words


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = sum(w[s] for s in order if s not in capped)
        share = left / open_ if open_ else 0
        over = {s for s in order if s not in capped and share * w[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else share * w[s] for s in order}
        capped |= over


def collect(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["source_key"], r["unit"], r["copies"]))


@pytest.mark.parametrize("options", [{}, {"bucket_units": 40, "fan_in": 2}])
def test_targets_sizes_and_words_taken(spark, options):
    rows = awkward_rows(n=400)
    df = frame(spark, rows, extra=True)
    got = collect(mixing.mix(df, **options))
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    want = brute_targets(sizes)
    per_source = {}
    for r in got:
        source = r["source_key"][1:] if r["source_key"] else None
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        per_source[source] = per_source.get(source, 0) + r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s, t in want.items():
        assert abs(per_source[s] - t) <= 0.02 * t + 60
    assert got == collect(mixing.mix(df.repartition(7), **options))  # reruns and partitioning do not matter


def test_cap_is_reshared():
    want = brute_targets({"a": 1, "b": 1000, "c": 2})
    assert want == {"a": 3, "b": 994, "c": 6}


def test_capped_source_takes_three_copies(spark):
    df = frame(spark, [(1, "x", "en", "a", 1), (2, "y " * 1000, "en", "b", 1), (3, "z z", "en", "c", 1)])
    got = {r["doc_id"]: r for r in collect(mixing.mix(df))}
    assert (got[1]["taken"], got[3]["taken"]) == (3, 6)
    assert got[2]["target"] == pytest.approx(994)


def test_documents_are_repeated_with_their_columns(spark):
    df = frame(spark, awkward_rows(), extra=True)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    copies = {}
    for r in mixing.mix(df).collect():
        copies[r.source_key, r.doc_id] = copies.get((r.source_key, r.doc_id), 0) + r.copies
    taken = {}
    for r in out.collect():
        key = ("=" + r.source if r.source is not None else "", r.doc_id)
        taken[key] = taken.get(key, 0) + 1
    assert taken == {k: n for k, n in copies.items() if n}


def test_rows_that_share_id_and_source_are_units_of_their_own(spark):
    rows = [(1, "a b", "en", "s", 1), (1, "a b c", "en", "s", 1), (None, "a", None, "s", 1), (None, "b b", None, "s", None)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == [(0, 1), (0, 2), (1, 2), (1, 3)]
    assert all(r["source_size"] == 8 and r["taken"] == r["copies"] * r["size"] for r in got)


def test_equal_rows_are_written_out_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 7)
    rows = [(None, "same words", "en", "a", 1)] * 300 + [(k, "x y z", "en", "b", 1) for k in range(50)] + [(7, None, None, "a", 1)] * 20
    df = frame(spark, rows, extra=True)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns
    taken = sum(r["copies"] for r in got if r["doc_id"] is None)
    assert 0 < taken == out.where("doc_id IS NULL").count()
    # nulls of different columns do not make rows equal
    mixed = [(1, "a b c d e", None, "s", 1), (1, None, "a b c d e", "s", 1)]
    texts = {r.text for r in mixing.mix_documents(frame(spark, mixed)).collect()}
    assert "a b c d e" in texts


def test_no_group_of_the_tree_grows_with_the_number_of_sources(spark):
    # the open units of level 1: one of each of 100,000 sources, in two buckets
    units = spark.range(100_000).selectExpr("concat('=', id) AS source_key", "id % 2 AS bucket")
    for buckets in (1, 2):
        level = units.withColumn("bucket", units["bucket"] % buckets)
        largest = level.groupBy(*mixing.level_groups(1, 100_000, buckets, 1000)).count().agg({"count": "max"}).first()[0]
        assert largest < 1200


def test_many_sources(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 5 AS int)) AS text",
                                      "'en' AS lang", "concat('s', id % 700) AS source", "1L AS n_chars")
    got = mixing.mix(df, bucket_units=100, fan_in=4).collect()
    assert len(got) == 3000 and all(0 <= r["copies"] <= 3 for r in got)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source_key"], []).append(r)
    for rows in by_source.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 5


def test_pivot_keeps_words_and_rounds_all_but_one():
    sizes, due = [7, 5, 9, 4, 6, 8], [0.3, 0.7, 0.5, 0.2, 0.9, 0.4]
    out, held, f = mixing.pivot(list("abcdef"), sizes, due, "s")
    taken = sum(s * x for s, x in zip(sizes, out, strict=True)) + (sizes[held] * f if held is not None else 0)
    assert taken == pytest.approx(sum(s * d for s, d in zip(sizes, due, strict=True)))


def test_pivot_keeps_expectations():
    n, hits = 4000, [0, 0, 0]
    for k in range(n):
        out, held, f = mixing.pivot(["a", "b", "c"], [3, 2, 4], [0.25, 0.5, 0.6], f"r{k}")
        for i in range(3):
            hits[i] += f if i == held else out[i]
    assert [h / n for h in hits] == pytest.approx([0.25, 0.5, 0.6], abs=0.03)


def test_empty_and_wordless(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    got = mixing.mix(frame(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])).collect()
    assert [(r["size"], r["taken"]) for r in got] == [(0, 0)] * 2
