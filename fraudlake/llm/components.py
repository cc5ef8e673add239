"""Connected components of an edge table: smallest labels, spread over edges and over labels themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import written


def component_labels(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id of edges (a, b; read in every round).

    Each round takes the smallest label next door, then the label of that label, so chains shrink
    by half and stars at once. Every round is a written table.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b")
    both = written(both.distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("_near")), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("_near").alias("_near"))
        )
        lower = labels.join(near, "id").select("id", F.least("component", "_near").alias("_to"), "component")
        hop = labels.select(F.col("id").alias("_to"), F.col("component").alias("_hop"))
        # a label is itself an id of the component, so it has a label
        new = written(
            lower.join(hop, "_to").select(
                "id", F.least("_to", "_hop").alias("component"), (F.least("_to", "_hop") != F.col("component")).alias("_moved")
            ),
            "labels",
        )
        labels = new.select("id", "component")
        if new.filter("_moved").isEmpty():
            return labels
