"""Connected components of links between documents, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b); the component is its smallest node.

    Each round takes the smallest label among neighbours and then the label of that label, so chains
    shorten by half and stars are done in one round. A hub's rows are reduced to one before the
    shuffle. Every round is written to the shared folder, so a lost executor costs one round."""
    edges = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = cut_lineage(edges, ids=True)
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    while True:
        lowest = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("lowest"))
        near = labels.join(lowest, labels["node"] == lowest["a"], "left").select("node", F.col("component").alias("old"), F.least("component", "lowest").alias("near"))
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("beyond"))
        rounds = cut_lineage(near.join(roots, near["near"] == roots["root"], "left").select("node", "old", F.least("near", "beyond").alias("component")), ids=True)
        labels = rounds.select("node", "component")
        if rounds.where("old <> component").isEmpty():
            return labels
