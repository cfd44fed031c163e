"""Connected components: the smallest node that each node reaches, by labels and pointer jumps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); nodes without links do not appear."""
    both = settle(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = settle(
            labels.join(near, "node")
            .join(up, "component")
            .select("node", F.least("component", "near", "up").alias("component"), F.col("component").alias("was")),
            "labels",
        )
        labels = new.select("node", "component")
        if new.where("component < was").isEmpty():
            return labels
