"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import BROADCAST_ROWS, cut, sized
from tabreg.sources.scratch import drop, keep, scoped


@scoped
def components(links: DataFrame, a: str = "a", b: str = "b", limit: int = BROADCAST_ROWS) -> DataFrame:
    """node, label for every node of ``links``; label is the smallest node it reaches.

    Each step gives a node the smallest label among its neighbours and then
    the label of that label, so long chains shrink fast; every step's table is
    cut off from its lineage. Label tables of up to ``limit`` rows are
    broadcast, larger ones joined by shuffles. No links: no rows. Null ends
    are ignored.
    """
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = cut(links.select(F.col(a).alias("x"), F.col(b).alias("y")).union(
        links.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), "links")
    n = both.count()
    labels = cut(both.groupBy("x").agg(F.min("y").alias("y"))
                 .select(F.col("x").alias("node"), F.least("x", "y").alias("label")), "labels", n)
    while True:
        known = sized(labels.select("node", "label"), n, limit)
        near = both.join(known.withColumnsRenamed({"node": "y"}), "y").groupBy("x").agg(F.min("label").alias("near"))
        step = (near.join(known, near.x == known.node)
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        far = known.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = cut(step.join(far, "label").select("node", "old", F.least("label", "far").alias("label")), "labels", n)
        drop(labels)
        labels = step
        if step.where("label != old").isEmpty():
            keep(labels)
            return labels.select("node", "label")
