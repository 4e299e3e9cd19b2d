"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared_files import stored


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, for every node of ``edges`` (a, b).

    Each round a node takes the smallest label among its neighbours and then that label's own
    label, which halves long chains. The minimum is summed up before the shuffle, so a node with
    very many neighbours costs one row per task; rounds are tables in the shared folder.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(seen, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = lower.join(jump, "label").select("node", F.least("label", "next").alias("label"), "old")
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels
