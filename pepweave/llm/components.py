"""Connected components of a link table by contraction, all of it in DataFrame operations.

Each round every node hooks onto its least neighbour, the pointers are followed to their roots by doubling, and the links
are rewritten to the roots; links inside a root vanish. No node's links are ever gathered: the least neighbour is an
aggregate that combines on the map side. Every round ends in the shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pepweave.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Returns node, label: the least node of its component, for every node that has a link.

    Null ends and loops are ignored; repeated links are as one; no links give an empty result.
    """
    edges = cut(links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        # only the larger end needs a pointer: a root is less than all its neighbours
        parent = cut(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "parent")
        while True:
            over = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            step = parent.join(over, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved"))
            parent = cut(step, "parent")
            if parent.where("moved").isEmpty():
                break
            parent = parent.select("node", "up")
        parent = parent.select("node", "up")
        if labels is None:
            roots = edges.select(F.col("a").alias("node")).distinct().join(parent, "node", "left_anti").select("node", F.col("node").alias("label"))
            labels = parent.withColumnRenamed("up", "label").unionByName(roots)
        else:
            labels = labels.join(parent.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("up", "label").alias("label"))
        labels = cut(labels, "labels")
        for end in ("a", "b"):
            edges = edges.join(parent.select(F.col("node").alias(end), F.col("up").alias("to")), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        edges = cut(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
