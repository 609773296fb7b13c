"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import write_through


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    Each round takes the smallest label among a node and its neighbours and then the label of
    that label, so chains shrink by half or more. Labels are stored each round; minima are
    aggregated before they are shuffled, so a node with very many links costs no more than
    others. No links give no rows.
    """
    pairs = links.select("a", "b").filter(F.col("a") != F.col("b"))
    both = write_through(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = write_through(first, "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        best = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("label").alias("far"))
        stepped = best.join(jump, "best", "left").select(
            "node", F.least("best", "far").alias("label"), (F.least("best", "far") != F.col("old")).alias("changed")
        )
        stored = write_through(stepped, "labels")
        labels = stored.select("node", "label")
        if stored.filter("changed").isEmpty():
            return labels.withColumnRenamed("label", "component")
