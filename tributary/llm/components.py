"""Connected components of an edge table, as Spark joins with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import materialize, scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges(a, b): label is the smallest node that can be reached.

    Every round takes the smallest label among the neighbours and then follows the label of the label, so the number of
    rounds grows with the logarithm of the diameter. Only the count of changed rows reaches the driver; each round is
    written, and deleted at the end. Nulls and loops are left out; repeated edges do no harm; no edges give no rows.
    """
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    with scratch():
        both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
        labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
        moved = True
        while moved:
            near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
            stepped = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("to"))
            # the label's own label, as of the round before: never larger
            up = labels.select(F.col("node").alias("to"), F.col("label").alias("above"))
            labels = materialize(stepped.join(up, "to").select("node", F.col("above").alias("label"), (F.col("above") != F.col("old")).alias("moved")), "labels")
            moved = labels.where("moved").limit(1).count() > 0
            labels = labels.select("node", "label")
        return materialize(labels, "components", stays=True)
