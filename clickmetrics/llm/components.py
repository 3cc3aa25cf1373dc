"""Connected components by smallest labels, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.llm.common import keep_files


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node in ``edges`` (a, b): label is the smallest node it is linked with.

    Each round takes the smallest label among neighbours, then the label of the label, so long chains
    need few rounds. Minima combine in every task before they are shuffled; rounds go through files.
    """
    spark = edges.sparkSession
    both = keep_files(spark, edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "edges")
    labels = keep_files(
        spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels"
    )
    while True:
        spread = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "label")
        lower = labels.select("node", "label").unionByName(spread).groupBy("node").agg(F.min("label").alias("label"))
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = lower.join(onward, "label", "left").select("node", F.least("label", "next").alias("label"))
        after = keep_files(spark, jumped, "labels")
        before = labels.select("node", F.col("label").alias("old"))
        changed = after.join(before, "node").where("label <> old").limit(1).count()
        labels = after
        if not changed:
            return labels
