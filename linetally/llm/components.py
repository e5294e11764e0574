"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.env import forget, written


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (long). Returns v, label: each linked vertex with the smallest vertex it can reach.

    Every round takes the smallest label among a vertex and its neighbours and then the label of that label, so chains
    shorten by doubling and stars are done in one round. Rounds are written to shared scratch, and removed when the next is; the driver sees counts.
    """
    links = links.where("a <> b").select("a", "b")
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    # a vertex starts from its smallest neighbour
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        mine = labels.join(near, labels["v"] == near["a"]).select("v", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("v").alias("next"), F.col("label").alias("far"))
        moved = mine.join(jump, "next", "left").select("v", F.coalesce(F.least("next", "far"), "next").alias("label"), (F.coalesce(F.least("next", "far"), "next") < F.col("label")).alias("changed"))
        moved = written(moved, "labels")
        forget(labels)
        labels = moved.select("v", "label")
        if not moved.where("changed").limit(1).count():
            forget(both)
            return labels
