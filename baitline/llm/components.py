"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.llm.common import saved


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """node, label: the smallest node reachable over the links (a, b), for every node of a link.

    Every round each node takes the smallest label among its neighbours, then the label of
    its label; rounds go on until nothing changes. A node with many links is pre-aggregated.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = saved(both, folder, f"{name}-edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = labels.select("node", F.least("node", "label").alias("label"))
    labels, turn = saved(labels, folder, f"{name}-0"), 0
    while True:
        turn += 1
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        best = (labels.join(near, "node")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("to")))
        far = labels.select(F.col("node").alias("to"), F.col("label").alias("far"))
        labels = saved(best.join(far, "to", "left")
                       .select("node", "old", F.least("to", F.coalesce("far", "to")).alias("label")),
                       folder, f"{name}-{turn}")
        moved = labels.filter("label < old").limit(1).count()
        labels = labels.select("node", "label")
        if not moved:
            return labels
