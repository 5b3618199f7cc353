"""Connected components of an edge table by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the component's smallest node.

    Each round takes the smallest label among a node's neighbours, then follows labels once, and is written to
    the shared scratch folder. A node with many edges is reduced in the tasks before the shuffle.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a != b"), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")),
        "labels",
    )
    while True:
        known = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        roots = labels.select(F.col("node").alias("next"), F.col("label").alias("root"))
        jumped = lower.join(roots, "next").select("node", F.least("next", "root").alias("next"), F.col("label").alias("old"))
        done = stored(jumped, "labels")
        labels = done.select("node", F.col("next").alias("label"))
        if done.filter("next != old").isEmpty():
            return labels
