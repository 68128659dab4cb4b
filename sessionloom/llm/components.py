"""Connected components of a graph given by its edges.

Every round each node tells its neighbours the smallest label it knows and takes the smallest it
hears, then labels jump to their label's label.  Labels are written to the shared folder each
round, so lineage stays short; the number of rounds grows with the logarithm of a component's
diameter.  A node with very many edges is combined before the shuffle (a minimum).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.workspace import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every end of an edge (a, b), the smallest node it reaches."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.union(both.select(F.col("other").alias("node"), F.col("node").alias("other")))
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("component"))
    labels = materialize(labels, "labels")
    edges = materialize(both.where("node <> other").distinct(), "edges")
    while True:
        heard = (
            edges.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("heard"))
        )
        lower = labels.join(heard, "node", "left").select(
            "node", F.least("component", "heard").alias("next"), F.col("component").alias("was")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("further"))
        moved = lower.join(jump, "next", "left").select(
            "node", F.least("next", "further").alias("component"), "was"
        )
        moved = materialize(moved, "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> was").isEmpty():
            return labels
