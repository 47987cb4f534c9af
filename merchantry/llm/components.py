"""Connected components of an edge table, by rounds of smallest labels and label jumps on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs -> (node, label), label the smallest node reachable; nodes without edges aren't listed.

    Each round takes the smallest label around a node and then the label of that label, so long chains halve. Rounds end when nothing changes.
    Aggregation combines before its shuffle, so a node with very many edges is no hot spot; nothing goes through the driver but a count.
    """
    both = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label"))
    labels = stored(labels, "cc-labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("l")), "other")
        nearest = around.groupBy("node").agg(F.min("l").alias("l"))
        low = labels.join(nearest, "node").select("node", F.col("label").alias("was"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        # A label is a node of its own component, so it has a label.
        after = stored(low.join(jump, "label").select("node", "was", F.least("label", "far").alias("label")), "cc-labels")
        changed = after.filter("was <> label").count()
        labels = after.select("node", "label")
        if not changed:
            return labels
