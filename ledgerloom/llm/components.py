"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node that can be reached, for every node of an edge.

    ``edges`` has the columns ``a`` and ``b``; direction, repeats and loops do not
    matter, and an empty table gives an empty one. In each round a node takes the
    smallest label among itself and its neighbours, then the label of its label,
    so long chains shrink to a fraction per round. Labels are folded per task
    before they are shuffled; each round's labels are a written table.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    if labels.isEmpty():
        return labels
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearest = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = nearest.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = nearest.join(jump, "label").select("node", "old", F.least("label", "far").alias("label"))
        labels = written(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
