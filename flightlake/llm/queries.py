"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import (ann, lattice_lm, line_filter, mixing, ngram_join, packing, periodic_runs, quality_net,
                            quality_rules, quality_rules_sql, repeats, source_audit, text_sql, token_counts, toxicity)
from flightlake.llm.common import read_table, remainder

#: Vocabulary files, by name.
WORD_TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.block_matrix_join(rows.where(F.col("vec_id") % 100 == 0), rows, k=10)


def _verdicts(scored: DataFrame, modulus: int, held: int) -> DataFrame:
    return scored.select("doc_id", (remainder("doc_id", modulus) == held).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    weights = toxicity.fit_labels(docs, labels, "toxic", learn=remainder("doc_id", 5) != 0)
    return _verdicts(toxicity.score(docs, weights, ["doc_id"]), 5, 0)


def op4_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    net = quality_net.fit_labels(docs, labels, "quality", learn=remainder("doc_id", 3) != 1)
    return _verdicts(quality_net.score(docs, net, ["doc_id"]), 3, 1)


def op3_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op6_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op7_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_viterbi_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path(PIECES), ["doc_id"])


def op9_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lattice_lm.score_documents(read_table(spark, sf_dir, "documents"), remainder("doc_id", 5) != 1,
                                        public_tokenizers.path(PIECES))
    return scored.withColumn("held_out", ~F.col("learned")).drop("learned")


def op10_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.robust_outliers(read_table(spark, sf_dir, "documents")).drop("distance")


def op11_quadtree_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


def op12_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", periodic_runs.looped_tail().alias("text"))
    return periodic_runs.periodic_runs(docs, columns=("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                      "runs_sha256", "collapsed_sha256"))


def op13_two_filter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_filter.remove_common_lines(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_block_matrix_neighbours, op2_counterfactual_toxicity, op3_pivotal_mixing,
                          op4_byte_network, op5_ordered_packing,
                          op6_token_group_join, op7_run_length_repeats,
                          op8_viterbi_token_counts, op9_lattice_likelihood,
                          op10_robust_outliers, op11_quadtree_source_audit, op12_recompression_runs, op13_two_filter_lines)
}

ORACLE_SQL: dict[str, str] = {
    "op1_block_matrix_neighbours": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        d AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                                    lambda a, b: a + b)) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
            WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
        WHERE rank <= 10""",
    "op6_token_group_join": text_sql.SHINGLE_COMPONENTS,
    "op7_run_length_repeats": text_sql.REPEATED_BYTES,
    "op10_robust_outliers": quality_rules_sql.sql(),
    "op11_quadtree_source_audit": source_audit.sql(),
    "op13_two_filter_lines": r"""
        WITH lines AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
        common AS (
            SELECT key, max(doc_id) AS stays FROM lines WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        told AS (
            SELECT l.*, c.key IS NOT NULL AND l.doc_id <> c.stays AS gone FROM lines l LEFT JOIN common c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM told GROUP BY doc_id""",
}
