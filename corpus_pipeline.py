"""A training-data pipeline over ``documents``: filter, deduplicate, cut repeats, mix, pack.

``STAGES`` lists the stages in order.  Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; ``run`` writes it as Parquet below ``spark.checkpoint.dir``
and hands the table, read again, to the next stage.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import mixing, ngram_join, packing, quality_net, repeats
from flightlake.llm.common import read_table, remainder, written
from flightlake.llm.queries import WORD_TOKENIZER


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the byte network rejects go."""
    labels = read_table(spark, sf_dir, "labels")
    net = quality_net.fit_labels(docs, labels, "quality", learn=remainder("doc_id", 3) != 1)
    return quality_net.accepted(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each component of similar documents stays."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: bytes of passages that occur earlier are cut out (and ``n_chars`` follows)."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents are dropped or repeated until the sources meet their targets."""
    return mixing.mix_documents(docs)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the pieces of the packed sequences."""
    pieces = packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("windows", windows),
]

#: A trained network decides the first stage: no SQL expresses it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
