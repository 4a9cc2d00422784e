"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node reachable over ``links`` (a, b); linked nodes only.

    Every round hooks each node to the smallest label next to it and then follows labels once more
    (pointer jumping), so long chains shrink by half a round.  Rounds are written to the shared folder.
    """
    edges = links.where("a <> b").select("a", "b")
    edges = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    if labels.isEmpty():
        return labels
    while True:
        # The smallest label among a node's neighbours, offered to the node and to its present label.
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        seen = labels.join(near, "node").select("node", "label", F.least("label", "seen").alias("low"))
        offers = seen.select("node", "low").union(seen.select(F.col("label").alias("node"), "low"))
        hooked = offers.groupBy("node").agg(F.min("low").alias("label"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        fresh = hooked.join(jump, "label", "left").select("node", F.least("label", F.coalesce("above", "label")).alias("label"))
        fresh = stored(fresh, "labels")
        changed = fresh.join(labels.withColumnRenamed("label", "before"), "node", "left").where(~F.col("label").eqNullSafe(F.col("before")))
        done = changed.isEmpty()
        labels = fresh
        if done:
            return labels
