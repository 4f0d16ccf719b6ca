"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.storage import discard, staged


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the least node that it is linked to.

    Each round gives every node the least label among its own, its neighbours' and, in turn, that
    label's own label; rounds end when no label changes. Nothing but a count reaches the driver.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        stepped = labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("component").alias("up"))
        stepped = staged(stepped.join(up, "label", "left").select("node", "before", F.least("label", F.coalesce("up", "label")).alias("component")), "labels")
        changed = stepped.filter(F.col("before") != F.col("component")).limit(1).count()
        discard(labels)
        labels = stepped.select("node", "component")
        if not changed:
            discard(both)
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
