"""Connected components of an edge table by repeated minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges ``a``-``b``; the root is the smallest node of the component.

    Every round gives a node the smallest label among its own and its neighbours', then replaces labels by
    their labels, so that long chains shrink quickly. Labels are summed up before the shuffle, and a hub is
    one partial minimum per task. An empty edge table gives no rows.
    """
    both = checkpointed(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        # a label is itself a node: its own label is at least as small
        of = step.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        step = step.join(of, F.col("root") == F.col("_node"), "left").select("node", "old", F.least("root", "_root").alias("root"))
        step = checkpointed(step)
        labels = step.select("node", "root")
        if step.where("root <> old").limit(1).count() == 0:
            return labels
