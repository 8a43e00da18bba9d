"""Connected components of links, found by shuffles only.

Large and small stars alternate: every node hands its larger neighbours, then
its smaller ones, to the least node it knows, until all components are stars.
Each round costs a few joins over the links; the number of rounds grows with the
logarithm of the longest path. The least of a node's neighbours is aggregated
with partial minima, and joins with it are ones that Spark splits if a node has
very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martflow.llm.stored import stored


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _checksum(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` of all nodes in links ``a``, ``b`` (longs).

    The component is its least node. Nulls and links of a node with itself are
    ignored; nodes without links don't appear.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = stored(links.where("a <> b").select(larger, smaller).distinct())
    before = _checksum(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hubs = _least_neighbour(both).select("a", F.least("a", "least").alias("least"))
        large = (
            both.join(hubs, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        large = stored(large)
        hubs = _least_neighbour(large)
        small = (
            large.join(hubs, "a")
            .where("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(hubs.select("a", F.col("least").alias("b")))
            .distinct()
        )
        stars = stored(small)
        after = _checksum(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
