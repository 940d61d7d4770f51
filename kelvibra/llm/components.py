"""Connected components of a graph that may not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.llm.stores import stored


def connected(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node reachable, for all nodes of the edges `a`, `b` (integers).
    Every step takes the smallest label among neighbours, then the label of that label, so that distances
    halve; busy nodes are aggregated before they are shuffled. No edges give no rows."""
    ends = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    ends = stored(ends)
    labels = stored(ends.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        near = (ends.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        moved = labels.join(near, "node").select("node", F.col("component").alias("old"),
                                                 F.least("component", "near").alias("new"))
        further = labels.select(F.col("node").alias("new"), F.col("component").alias("far"))
        labels = stored(moved.join(further, "new").select("node", "old", F.least("new", "far").alias("component")))
        if not labels.filter("old <> component").take(1):
            return labels.select("node", "component")
        labels = labels.select("node", "component")
