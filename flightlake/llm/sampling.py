"""A bounded sample of labelled documents, for fitting the classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, learn=None,
                    id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """At most ``rows`` labelled texts (columns ``text``, ``y``), the same ones on every run.

    ``learn`` filters the labelled ids (a Column).  Rows are chosen by a hash of the
    id, so the choice does not depend on order or place.  Only ids of the chosen
    labels, at most ``rows`` of them, are broadcast; only their texts are collected.
    """
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    if learn is not None:
        chosen = chosen.where(learn)
    chosen = (chosen.groupBy(F.col(id_col).alias("k")).agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("k"), "k").limit(rows))
    found = docs.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = (found.join(F.broadcast(chosen), "k").orderBy(F.xxhash64("k"), "k", F.xxhash64("text"))
           .limit(rows).select("text", "y").toArrow())
    return out.to_pandas()
