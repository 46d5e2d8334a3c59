"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of `edges` (a, b long).

    In a round each node takes the least label of its neighbours, and then the
    label of its label, until none changes; so chains take about the logarithm
    of their length in rounds. Labels are gathered by partial minima, so a hub
    costs each task one row.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("component")
        )
    )
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, labels.node == near.a).select(
            "node", F.least("component", "near").alias("least"), F.col("component").alias("was")
        )
        of_label = labels.select(F.col("node").alias("least"), F.col("component").alias("next"))
        new = cut(
            lower.join(of_label, "least").select(
                "node", F.least("least", "next").alias("component"), "was"
            )
        )
        labels = new.select("node", "component")
        if new.filter("component <> was").isEmpty():
            return labels
