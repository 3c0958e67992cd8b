"""Exact search for the k highest inner products, with a KD-tree per shard.

Components are turned into whole numbers, so scores are exact. The vectors are dealt
into shards of bounded size. In a shard a tree splits the points at the median of the
widest dimension; every node keeps the tight box of its points. A query visits the
leaves in the order of the largest score their boxes allow and stops when no box can
reach its kth score. The first round searches each query's own shard only; the kth
score found there goes with the query to all other shards. Queries travel in blocks
of bounded size, so no task holds more than one shard and one block.

Vectors that are null, or hold null or non-finite components, take no part; vectors of
different lengths never meet. A row whose vec_id is null is a candidate, behind all
others at equal scores, but no query. Of repeated rows each is a query and a candidate of
its own; only the row itself is not its own candidate. Components beyond a long count
as the nearest long, as do scores. An empty table gives an empty result; further columns
are left alone.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cabrank.llm.common import saved

K, EVERY, SCALE = 10, 100, 1024
LEAF = 128
SHARD, LEAST_SHARD = 65_536, 4_096
#: Bytes the components of a shard may have on average, as whole numbers; shards of long vectors hold fewer of them.
SHARD_BYTES = 1 << 26
BLOCK = 16_384
EXACT = 2**53
FOUND = "query_row long, query_id long, kth long, row long, vec_id long, score long"

class Tree:
    """Points in boxes; a node is a slice of ``order`` with the tight bounds of its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []
        lows, highs = [], []
        open_slices = [(0, len(points), -1)]
        kids: list[list[int]] = []
        while open_slices:
            start, end, parent = open_slices.pop()
            own = points[self.order[start:end]]
            low, high = own.min(axis=0), own.max(axis=0)
            number = len(kids)
            kids.append([])
            lows.append(low)
            highs.append(high)
            self.nodes.append((start, end, parent, number))
            if parent >= 0:
                kids[parent].append(number)
            widest = int(np.argmax(high - low)) if own.shape[1] else 0
            if end - start > leaf and own.shape[1] and high[widest] > low[widest]:
                middle = (end - start) // 2
                self.order[start:end] = self.order[start:end][np.argpartition(own[:, widest], middle)]
                open_slices += [(start, start + middle, number), (start + middle, end, number)]
        self.kids = kids
        self.low, self.high = np.array(lows), np.array(highs)
        self.points = points[self.order]

    def search(self, query: np.ndarray, order: np.ndarray, k: int, kth, own: int) -> list[tuple]:
        """(score, order, place) of the k best points whose score is not below ``kth``; ``own`` is left out.

        ``order`` numbers the points as equal scores are to be ranked.
        """
        bounds = np.maximum(query, 0) @ self.high.T + np.minimum(query, 0) @ self.low.T
        best: list[tuple] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < kth:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(heap, (-bounds[kid], kid))
                continue
            start, end, _, _ = self.nodes[node]
            scores = self.points[start:end] @ query
            at = np.nonzero(scores >= kth)[0]
            if not len(at):
                continue
            places = self.order[start + at]
            new = [(s, i, p) for s, i, p in zip(scores[at].tolist(), order[places].tolist(), places.tolist()) if p != own]
            best = heapq.nsmallest(k, best + new, key=lambda x: (-x[0], x[1]))
            if len(best) == k:
                kth = max(kth, best[-1][0])
        return best


def matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.int64) if len(rows) else np.zeros((0, 0), np.int64)


def exact_types(points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every sum stays exact in them, else as Python's unbounded whole numbers."""
    peak = max(map(float, (points.max(initial=0), -float(points.min(initial=0)), 1)))
    other = max(map(float, (queries.max(initial=0), -float(queries.min(initial=0)), 1)))
    kind = np.float64 if peak * other * max(1, points.shape[1]) < EXACT else object
    return points.astype(kind), queries.astype(kind)


def clamp(score) -> int:
    return min(max(int(score), -(2**63)), 2**63 - 1)


def search_shard(queries: pd.DataFrame, points: pd.DataFrame, k: int, leaf: int = LEAF) -> pd.DataFrame:
    """The best candidates of one shard for a block of queries, with the kth score known for each query afterwards."""
    rows: list[tuple] = []
    if len(queries) and len(points):
        held, asked = exact_types(matrix(points["v"]), matrix(queries["v"]))
        tree = Tree(held, leaf)
        place = {row: i for i, row in enumerate(points["row"].tolist())}
        known, ids, numbers = (points[c].to_numpy() for c in ("known", "vec_id", "row"))
        order = np.empty(len(points), np.int64)
        order[np.lexsort((numbers, ids, ~known))] = np.arange(len(points))
        for query, number, query_id, kth in zip(asked, queries["query_row"], queries["query_id"], queries["kth"]):
            least = -math.inf if kth == -(2**63) else int(kth)
            best = tree.search(query, order, k, least, place.get(number, -1))
            kth = max(kth, clamp(best[-1][0])) if len(best) == k else kth
            rows += [(number, query_id, kth, numbers[p], ids[p] if known[p] else None, clamp(s)) for s, _, p in best]
    return pd.DataFrame(rows, columns=["query_row", "query_id", "kth", "row", "vec_id", "score"]).astype({"vec_id": "Int64"})


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """row (a number of its own), vec_id and v: the components times ``scale``, rounded down."""
    usable = F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return embeddings.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_k(
    embeddings: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, shard: int = SHARD, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every row whose vec_id is divisible by ``every``."""
    spark = embeddings.sparkSession
    vectors = saved(quantised(embeddings, scale))
    asking = (F.col("vec_id") % every == 0) & F.col("vec_id").isNotNull()
    n, asked, components = vectors.agg(F.count("*"), F.count(F.when(asking, 1)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    shards = max(1, math.ceil(n / shard), math.ceil(8 * components / shard_bytes), min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST_SHARD)))
    blocks = max(1, math.ceil(asked / BLOCK))
    vectors = vectors.select("row", "vec_id", "v", F.size("v").alias("d"), F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
    # A null vec_id becomes a flag: pandas would turn the whole column into floating-point numbers.
    points = vectors.withColumns(
        {"block": F.explode(numbers(blocks)), "known": F.col("vec_id").isNotNull(), "vec_id": F.coalesce("vec_id", F.lit(0))}
    )
    queries = vectors.where(asking).select(
        F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), *[F.col(c).alias(c) for c in ("v", "d", "shard")],
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block"),
    )

    def searched(queries: DataFrame) -> DataFrame:
        keys = ["d", "shard", "block"]
        return (
            queries.groupBy(*keys)
            .cogroup(points.groupBy(*keys))
            .applyInPandas(lambda q, p: search_shard(q, p, k), FOUND)
        )

    unknown = F.lit(-(2**63)).cast("long")
    home = saved(searched(queries.withColumn("kth", unknown)))
    known = saved(home.groupBy("query_row").agg(F.max("kth").alias("kth")))
    away = (
        queries.join(known, "query_row", "left")
        .withColumn("kth", F.coalesce("kth", unknown))
        .withColumn("home", F.col("shard"))
        .withColumn("shard", F.explode(numbers(shards)))
        .where("shard <> home")
        .drop("home")
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        home.unionByName(searched(away))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
