"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (columns a, b); the component is its smallest
    node. Every round takes the smallest label among neighbours, then follows labels of labels, so
    long chains shrink by half and more; it stops when nothing changes."""
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "links")
    labels = materialize(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "component", F.least("component", "m").alias("low"))
        lower = materialize(lower, "labels")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        labels = materialize(lower.join(jump, "low", "left").select(
            "node", F.least("low", "lowest").alias("component"), (F.least("low", "lowest") != F.col("component")).alias("changed")), "labels")
        if labels.where("changed").isEmpty():
            return labels.select("node", "component")
