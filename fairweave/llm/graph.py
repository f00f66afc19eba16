"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairweave.llm._shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b): label is the least node reachable.

    Least labels spread along edges and jump through their own labels, so the rounds
    grow with the logarithm of the longest path.  Each round is a written table; only
    the number of changed labels reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    edge = written(both, "edges")
    label = written(edge.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = label.withColumnsRenamed({"node": "b", "label": "near"})
        near = edge.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = label.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        parent = step.select(F.col("node").alias("mid"), F.col("mid").alias("up"))
        label = written(step.join(parent, "mid").select("node", "old", F.least("mid", "up").alias("label")), "labels")
        if not label.where("label <> old").limit(1).count():
            return label.select("node", "label")
        label = label.select("node", "label")
