"""Connected components by joins and grouped minima; nothing passes through the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for each node of the edges; the label is the least node of its component.

    Each round a node takes the least label among its neighbours and itself, then the label of
    that label, until none changes.  Both joins are on a node, so Spark may split a hot one.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    links = scratch.table(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = scratch.table(links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")).select(
        "node", F.least("v", "node").alias("label")))
    while True:
        near = (links.join(labels.withColumnsRenamed({"node": "v"}), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        lower = scratch.table(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        if not lower.where("label != old").limit(1).count():
            scratch.drop(links, lower)
            return labels
        # Shortcut: the label's own label.
        beyond = lower.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        short = scratch.table(lower.join(beyond, "label").select("node", F.least("label", "beyond").alias("label")))
        scratch.drop(labels, lower)
        labels = short
