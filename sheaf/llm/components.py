"""Connected components of an edge table, without gathering it: smallest labels spread over edges and along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import dealt_out, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b): the smallest node that can be reached. Labels only shrink, and each round jumps along the labels, so paths halve."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        offered = both.join(dealt_out(labels), F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("offer"))
        best = labels.join(dealt_out(offered), "node").select("node", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = written(best.join(dealt_out(jump), "label").select("node", F.least("label", "far").alias("label"), "old"), "labels")
        labels = new.select("node", "label")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return labels
