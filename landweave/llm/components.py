"""Connected components of an edge list by least labels and pointer jumping, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landweave.llm.common import Scratch


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """node and component (the least node it reaches) for every node of edges (a, b: long).

    Every round takes each node's least neighbouring label and then that label's own label, so paths
    shorten by doubling. Neighbours are reduced on their own partitions before a shuffle; a node with very
    many edges meets its label in a join that Spark can split.
    """
    work = Scratch(edges.sparkSession)
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = work.saved(both.filter("a <> b").distinct(), "edges")
    labels = work.saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels-0")
    for k in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        up = labels.select(F.col("node").alias("to"), F.col("component").alias("up"))
        step = work.saved(step.join(up, "to", "left").select("node", "old", F.least("to", "up").alias("component")), f"labels-{k + 1}")
        work.drop(f"labels-{k}")
        labels = step.select("node", "component")
        if step.filter("component <> old").isEmpty():
            work.drop("edges")
            return labels
    raise RuntimeError("components did not settle")
