"""Connected components by minimum labels and pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


ROWS_PER_FILE = 200_000


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp): the smallest node reachable over ``links`` (a, b), for every node in a link.

    Each round hooks a node to the smallest label next to it, then halves the paths; rounds go on
    until nothing changes, about the logarithm of the longest path. A node with very many links is
    met only in grouped minima and in joins whose skew AQE can split.
    """
    both = scratch.write(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    # the written tables get as many files as their rows need, also where AQE doesn't merge partitions
    files = 1 + both.count() // ROWS_PER_FILE
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("comp"))
    labels = scratch.write(labels.coalesce(files))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        step = hooked.join(jump, "comp", "left").select("node", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp"))
        step = scratch.write(step.coalesce(files))
        changed = step.where("old <> comp").limit(1).count()
        scratch.drop(labels)
        labels = step.select("node", "comp")
        if not changed:
            return labels
