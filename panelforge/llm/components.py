"""Connected components over a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import land

#: Safety net only; the number of rounds grows with the logarithm of the longest path.
MOST_ROUNDS = 64


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for the nodes of ``links`` (a, b).

    Every round a node takes the least label among its own, its neighbours' and its
    label's label, and a label adopts the least label that its members saw next door,
    so paths halve. Labels are stored after each round, which cuts the lineage and
    survives lost executors. A round groups by key with map-side combining and joins
    against one row per node; no component is gathered anywhere.
    """

    both = land(links.select("a", "b").union(links.select("b", "a")).distinct(), "links-both-ways")
    labels = land(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "labels-0")
    for step in range(1, MOST_ROUNDS + 1):
        seen = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        joined = labels.join(seen, "node")
        # Proposals: a node's own label and what it saw, and for its label what it saw.
        own = joined.select("node", F.least("root", "near").alias("root"))
        hooks = joined.where("near < root").select(F.col("root").alias("node"), F.col("near").alias("root"))
        merged = own.unionByName(hooks).groupBy("node").agg(F.min("root").alias("root"))
        merged = land(merged, f"labels-{step}-merged")
        parents = merged.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        following = land(
            merged.join(parents, "root", "left").select("node", F.least("root", F.coalesce("grand", "root")).alias("root")),
            f"labels-{step}",
        )
        changed = following.join(labels.withColumnRenamed("root", "before"), "node").where("root <> before")
        if changed.isEmpty():
            return following
        labels = following
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
