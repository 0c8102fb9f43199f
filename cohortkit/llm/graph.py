"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b): label is the least node of its component.

    Each round takes the least label among the neighbours' and then that of
    the label itself, so the number of rounds grows with the logarithm of the longest path.  Labels are written
    to the shared folder each round; only a count of changes reaches the
    driver.  The least label is combined before the shuffle, so a node with very many
    edges costs one row per task.
    """
    both = stored(edges.select("a", "b").filter("a <> b").distinct()
                  .select(F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*"), "graph-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "graph-labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = stored(labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "graph-step")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = stored(step.join(up, "label").select("node", "old", F.least("label", "above").alias("label")), "graph-labels")
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
