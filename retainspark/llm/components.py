"""Connected components of an edge list, by minimum labels and pointer jumps.

Every round joins and aggregates by node with map-side combine, so a node of
very many edges is no hot group, and ends in a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retainspark.session import stable


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (``a``, ``b``, both long):
    ``label`` is the smallest node that can be reached.  An empty edge list
    gives an empty result; loops and repeated edges do no harm."""
    both = stable(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = stable(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = (both.join(labels, both["b"] == labels["node"])
                .groupBy("a").agg(F.min("label").alias("near")))
        low = (labels.join(near, labels["node"] == near["a"])
               .select("node", F.least("label", "near").alias("low"),
                       F.col("label").alias("was")))
        low = stable(low)
        # the label is a node too: take over the label that node has by now
        jump = low.select(F.col("node").alias("target"), F.col("low").alias("next"))
        moved = stable(low.join(jump, low["low"] == jump["target"])
                       .select("node", F.col("next").alias("label"),
                               (F.col("next") != F.col("was")).alias("changed")))
        labels = moved.select("node", "label")
        if moved.filter("changed").isEmpty():
            return labels
