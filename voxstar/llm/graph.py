"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxstar.llm.staging import packed


def components(links: DataFrame, first: str = "u", second: str = "v") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node with a link.

    Each round gives a node the least label among its neighbours and then its label's label, so the rounds grow with the
    logarithm of the longest chain. Labels are checkpointed each round; sums combine before their shuffle, and
    a node with very many links is split by adaptive execution in the two joins.
    """
    n_edges = 2 * links.count()
    both = links.select(F.col(first).alias("a"), F.col(second).alias("b"))
    edges = packed(both.union(both.select("b", "a")).where("a <> b").distinct(), n_edges)
    labels = packed(edges.groupBy("a").agg(F.min("b").alias("low"))
                    .select(F.col("a").alias("node"), F.least("a", "low").alias("component")), n_edges)
    while True:
        near = (edges.join(labels, F.col("b") == F.col("node")).groupBy("a")
                .agg(F.min("component").alias("near")))
        better = packed(labels.join(near, F.col("node") == F.col("a"))
                        .select("node", "component", F.least("component", "near").alias("best")), n_edges)
        top = better.select(F.col("node").alias("up"), F.col("best").alias("top"))
        jumped = packed(better.join(top, F.col("best") == F.col("up"))
                        .select("node", "component", F.least("best", "top").alias("best")), n_edges)
        if jumped.where("best <> component").isEmpty():
            return labels
        labels = jumped.select("node", F.col("best").alias("component"))
