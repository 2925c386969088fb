"""Connected components of a graph given by edges, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(v, label): each vertex of ``edges`` (a, b) with the smallest vertex of its component.

    Each round takes the least label of all neighbours, then the label of that label. Rounds grow with the logarithm of
    the longest path; every round is kept in the shared folder.
    """
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = settle(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("low"))
        # labels are vertices, so the label of a label is there
        jump = lower.select(F.col("v").alias("low"), F.col("low").alias("jump"))
        after = settle(lower.join(jump, "low", "left").select("v", "label", F.least("low", F.coalesce("jump", "low")).alias("next")))
        changed = not after.filter("label <> next").isEmpty()
        labels = after.select("v", F.col("next").alias("label"))
        if not changed:
            return labels
