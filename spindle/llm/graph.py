"""Connected components of links between documents, as joins and aggregates over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``links`` (``a, b``): the smallest node that can be reached.

    Each round hooks every node to its smallest neighbour, jumps pointers twice, and contracts the links; a link whose
    ends meet is gone. At least every node with a smaller neighbour goes in a round, so the rounds grow with the
    logarithm of the nodes. Minima are combined map-side and the rest are joins, which Spark can split, so a node with
    very many links is no bottleneck. Rounds are written to the shared folder; nothing comes to the driver but whether
    links are left. Links with a null end and loops count for nothing.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = written(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        hooked = written(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "parents")
        up = hooked
        for _ in range(2):
            top = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            up = up.join(top, "up").select("node", F.col("top").alias("up"))
        up = written(up, "parents")
        to = lambda name: up.select(F.col("node").alias(name), F.col("up").alias(f"{name}_up"))
        old = labels, edges
        labels = written(labels.join(to("component"), "component", "left").select("node", F.coalesce("component_up", "component").alias("component")), "labels")
        edges = edges.join(to("a"), "a").join(to("b"), "b").filter("a_up <> b_up")
        edges = written(edges.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), "links")
        discard(*old, hooked, up)
    discard(edges)
    return labels
