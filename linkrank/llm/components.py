"""Connected components by rounds of smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.plans.workspace import Workspace


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes of ``(a, b)`` edges: the smallest node it reaches.

    Each round a node takes the smallest label around it, then its label's label. Every round
    is a written table; the labels of all nodes never meet in one place.
    """
    both = ws.save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = ws.save(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("a"), F.min("b")).alias("component")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("near"))
            .agg(F.min("component").alias("least"))
        )
        taken = ws.save(
            labels.join(around, labels.node == around.near).select(
                "node", F.col("component").alias("old"), F.least("component", "least").alias("new")
            ),
            "taken",
        )
        target = taken.select(F.col("node").alias("at"), F.col("new").alias("then"))
        again = ws.save(
            taken.join(target, taken.new == target["at"]).select("node", "old", "then"), "again"
        )
        labels = again.select("node", F.col("then").alias("component"))
        if again.where("old != then").isEmpty():
            return labels
