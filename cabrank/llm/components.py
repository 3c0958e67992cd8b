"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from cabrank.llm.common import saved

#: Links a partition holds about; the rounds keep as many files as the links need, not as many as a shuffle has partitions.
PER_PARTITION = 50_000


def _few(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(max(1, math.ceil(rows / PER_PARTITION)))


def _largest(links: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, or to the node itself."""
    both = links.union(links.select("low", "high")).toDF("node", "other")
    least = saved(_few(both.groupBy("node").agg(F.least("node", F.min("other")).alias("least")), 2 * rows))
    return both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))


def _smallest(links: DataFrame, rows: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = saved(_few(links.groupBy("high").agg(F.min("low").alias("least")), rows))
    moved = links.join(least, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(least.select("high", F.col("least").alias("low")))


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct links, kept, with their number and a checksum.

    A checkpoint hands on the size Spark estimates, and that of a join is the product of its inputs: after
    some rounds a number of millions of digits. Rows in the cache have their real size, so the estimate starts anew.
    """
    cached = links.distinct().persist()
    state = tuple(cached.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())
    kept = saved(_few(cached.select("high", "low"), state[0]))
    cached.unpersist()
    return kept, state


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node but the roots.

    ``links`` has two columns of comparable values; direction, repetition and
    links of a node to itself do not matter. The number of rounds grows with the
    logarithm of the size of a component. Only a count and a checksum reach the driver.
    """
    a, b = links.columns
    links = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    links, state = _kept(links)
    while state[0]:
        before = state
        stars = saved(_few(_largest(links, state[0]).distinct(), state[0]))
        links, state = _kept(_smallest(stars, state[0]))
        if before == state:
            break
    return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
