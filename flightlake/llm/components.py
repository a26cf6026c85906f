"""Connected components of a link table, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``: the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours and then the
    label of that label, so chains halve; tables are written between rounds, and only
    a count of changes reaches the driver.
    """
    both = links.select("a", "b").where(F.col("a") != F.col("b"))
    edges = written(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
                     "cc-labels")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        step = written(step, "cc-step")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "cc-labels")
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
