import corpus_pipeline
from flightlake.llm.common import read_table, written
from flightlake.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import awkward_rows, frame


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    names, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == names
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    total = pieces.groupBy("doc_id", "doc_tokens").count()
    assert {r.doc_id for r in total.collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_filter", "near_duplicates", "repeated_passages", "source_mix", "windows"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_later_stages_take_awkward_rows(spark):
    docs = frame(spark, awkward_rows())
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = written(stage(spark, docs, SF_SMALL), "test-awkward")
    assert docs.count() > 0
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, SF_SMALL), "test-empty")
    assert empty.count() == 0
