"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the least node of its component.

    Each step lets every node take the least label among itself and its
    neighbours, then that label's own label; the longest chains shrink by half
    or more a step. Every step is a written table. A hub's links are joined as
    they come from their exchange, so a skewed hub is split, and labels are
    combined before they are shuffled.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                     .select("node", F.least("node", "low").alias("label")), "cc-labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        )
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = written(
            taken.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "cc-labels")
        labels = step.select("node", "label")
        if step.filter("label != old").isEmpty():
            return labels
