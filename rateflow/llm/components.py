"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node of its component) for every node of ``edges``
    (long columns a, b).

    Each round a node takes the least label around it, then the label of its label, so the
    rounds grow with the logarithm of the longest path. Labels are minima, combined before the
    shuffle; a node with very many edges is no single task's work."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(around, "node").select("node", F.least("label", "near").alias("to"), "label")
        up = labels.select(F.col("node").alias("to"), F.col("label").alias("top"))
        new = written(nearer.join(up, "to").select("node", "label", F.least("to", "top").alias("new")), "labels")
        if new.filter("new < label").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", F.col("new").alias("label"))
