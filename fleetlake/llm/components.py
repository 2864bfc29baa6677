"""Connected components by smallest label and pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for all nodes of the links ``u``, ``v``."""
    both = staged(links.union(links.select("v", "u")).distinct(), "links")
    labels = staged(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")), "labels")
    while True:
        offered = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("root").alias("offer"))
        lower = labels.join(offered, labels.node == offered.u).select("node", F.col("root").alias("was"), F.least("root", "offer").alias("root"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("over"))
        labels = staged(
            lower.join(jump, lower.root == jump.via).select("node", "was", F.least("root", "over").alias("root")), "labels"
        )
        moved = labels.where("root <> was").limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels
