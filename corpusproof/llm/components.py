"""Connected components of an edge table by repeated minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusproof.llm.scratch import forget, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so a chain of n
    nodes ends after about log2(n) rounds.  Labels are written to the shared folder after each round, and those before removed;
    nothing but a count of changes comes to the driver.  No edges give no rows; self-loops and repeated edges do no harm.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    both = pairs.union(pairs.select("v", "u")).distinct().toDF("u", "v")
    both = written(both, "neighbours")
    labels = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root"))
    labels = written(labels, "labels")
    while True:
        near = both.join(labels.toDF("v", "r"), "v").groupBy("u").agg(F.min("r").alias("near"))
        step = labels.join(near.toDF("node", "near"), "node").select("node", "root", F.least("root", "near").alias("next"))
        hop = labels.toDF("next", "beyond")
        new = written(step.join(hop, "next").select("node", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") < F.col("root")).alias("moved")), "labels")
        before, labels = labels, new.select("node", "root")
        forget(before)
        labels._scratch_path = new._scratch_path
        if not new.where("moved").limit(1).count():
            forget(both)
            return labels
