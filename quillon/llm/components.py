"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node that it reaches) of every node in ``links`` (a, b).

    Each round, every node takes the smallest root among its neighbours' and then its
    root's root (pointer jumping), so the number of rounds grows with the logarithm of the
    longest path. Tables are staged between rounds; nothing comes to the driver but a count.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    labels = stage(labels, "roots")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        step = stage(step.join(up, "root").select("node", "was", F.least("root", "top").alias("root")), "roots")
        labels = step.select("node", "root")
        if step.where("root <> was").isEmpty():
            return labels
