"""Connected components of a graph of links, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)``, two long columns -> ``(node, component)``: the smallest node reachable.

    Every round takes the smallest label among the neighbours and then the label of that label,
    so the rounds grow with the logarithm of the longest path. A node with many links is a sum
    over many tasks: minima are taken before the shuffle. Rounds are checkpointed.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.where("a <> b").distinct())
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        hop = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("next")
        )
        of = labels.select(F.col("node").alias("of"), F.col("component").alias("further"))
        moved = hop.join(of, hop["next"] == of["of"], "left").select(
            "node", "old", F.least("next", F.coalesce("further", "next")).alias("component")
        )
        moved = materialize(moved)
        labels = moved.select("node", "component")
        if moved.where("old <> component").isEmpty():
            return labels
