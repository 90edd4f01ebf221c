"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanfold.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node of a link.

    Each round takes the smallest of a node's label, its neighbours' labels and
    the label of its label, so a chain shortens to its logarithm.  Labels live in
    written tables; only the number of changes reaches the driver.  Links to
    itself, repeated links and an empty table are allowed."""
    edges = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where(F.col("node") != F.col("other"))
    both = written(edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
                   .distinct(), "edges")
    labels = written(both.groupBy("node").agg(F.min("other").alias("least"))
                     .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("component").alias("near")))
        beyond = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        now = F.least("component", "near", "beyond")
        after = written(labels.join(near, "node").join(beyond, "component").select(
            "node", now.alias("now"), (now != F.col("component")).alias("moved")), "labels")
        labels = after.select("node", F.col("now").alias("component"))
        if not after.where("moved").limit(1).count():
            return labels
