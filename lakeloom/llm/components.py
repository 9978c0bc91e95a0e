"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.helpers import store


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the least node of its component.

    Each round a node takes the least label among its neighbours and then the label of its label, so
    that a chain shortens by more than half. Labels are stored every round; hubs are many edge rows, never one group.
    """
    pairs = store(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    current = store(pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("label")), "labels")
    while True:
        least = pairs.join(current, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(
            F.min("label").alias("seen"))
        near = current.join(least, F.col("node") == F.col("n")).select("node", "label", F.least("label", "seen").alias("to"))
        hop = current.select(F.col("node").alias("n"), F.col("label").alias("far"))
        after = store(near.join(hop, F.col("to") == F.col("n")).select(
            "node", F.least("to", "far").alias("label"), (F.least("to", "far") != F.col("label")).alias("moved")), "labels")
        current = after.select("node", "label")
        if after.filter("moved").isEmpty():
            return current
