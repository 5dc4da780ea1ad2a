"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """Each node of the edges (a, b) with the smallest node of its component: node, label.

    Each round gives a node, and the node that it is labelled with, the smallest label on the
    other side of its edges, and then follows labels one step further. Rounds are written out, so
    a lost executor costs one round at most. Only the count of changes reaches the driver.
    """
    pairs = kept(edges.select("a", "b").union(edges.select("b", "a")), "edges")
    labels = kept(pairs.groupBy("a").agg(F.min("b").alias("b")).selectExpr("a AS node", "least(a, b) AS label"), "labels")
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
        seen = pairs.join(of_a, "a").join(of_b, "b").where("label_b < label_a")
        best = (
            seen.select(F.col("a").alias("node"), F.col("label_b").alias("low"))
            .union(seen.select(F.col("label_a").alias("node"), F.col("label_b").alias("low")))
            .groupBy("node")
            .agg(F.min("low").alias("low"))
        )
        lower = labels.join(best, "node", "left").select("node", F.least("label", "low").alias("up"), F.col("label").alias("old"))
        above = lower.select(F.col("node").alias("up"), F.col("up").alias("label"))
        after = kept(lower.join(above, "up").select("node", "label", (F.col("label") != F.col("old")).alias("moved")), "labels")
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels
