"""Connected components over links, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import cut_lineage


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): component is the least id that a node is linked to over any number of links.

    nodes: id; links: a, b in either direction, any number of times. Each round a node takes the least label among
    itself, its neighbours and its label's label; rounds end when no label changes. The labels are written to the shared
    folder each round, so a lost executor loses nothing."""
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    edges = cut_lineage(edges)
    # Nodes without links are their own component and take no part in the rounds.
    labels = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), F.least("a", "least").alias("label"))
    labels = cut_lineage(labels)
    while True:
        around = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("seen"))
        own = labels.join(around, labels["id"] == around["a"]).select("id", "label", F.least("label", "seen").alias("next"))
        jump = labels.select(F.col("id").alias("at"), F.col("label").alias("further"))
        stepped = own.join(jump, own["next"] == jump["at"], "left").select("id", "label", F.least("next", F.coalesce("further", "next")).alias("next"))
        stepped = cut_lineage(stepped)
        if stepped.where("next < label").isEmpty():
            break
        labels = stepped.select("id", F.col("next").alias("label"))
    found = stepped.select("id", F.col("next").alias("component"))
    return nodes.select("id").join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
