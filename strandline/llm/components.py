"""Connected components of an edge table by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (columns a, b); root is the smallest node that can be reached.

    Every round takes the smallest label among a node's neighbours and then the
    label of that label, and is written to the shared folder, so lineage stays
    short. Aggregates run map-side first, so a hub costs one row a task.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node")
    while True:
        labels = written(labels, "labels")
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        moved = labels.join(near, labels["node"] == near["a"]).select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = written(moved.join(jump, "root", "left").select("node", F.coalesce("further", "root").alias("root"), "was"), "moved")
        labels = jumped.select("node", "root")
        if jumped.where(F.col("root") != F.col("was")).isEmpty():
            return labels
