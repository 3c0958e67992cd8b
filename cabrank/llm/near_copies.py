"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts are split into words as in ``simhash``; a text with fewer words than a shingle
has one shingle, all its words, so texts without words are copies of each other.
Shingles are compared by 64-bit hashes, texts are told apart by MD5.

Candidates are first the texts of one SimHash component, as ``simhash`` finds them: fingerprints that
differ in 2 or fewer bits, with no link lost. A component is a bucket. Most texts that are 0.8 alike
differ in more bits, so texts that agree in one of ``BANDS`` groups of ``ROWS`` minimum hashes are a bucket too.
A pair of similarity s that SimHash does not link is missed with probability (1 - s ** ROWS) ** BANDS, which is
0.00007 at 0.8 and less above. Everything after that is exact and compares no bucket pair by pair:

1. Every text of a bucket is compared with one of them, its hub: the text that shares most
   buckets, the same in all bands where it can be. That joins most of a group.
2. Texts that one hub has met and that are still in different components are compared by what
   they have and lack against the hub. Texts a, b of sizes m, n with differences D(a), D(b) from the hub
   differ in ``|D(a) ^ D(b)|`` shingles, at most (m + n) * (1 - s) / (1 + s), so they share a number of
   differences and meet in one of their rarest, as many as a prefix filter asks for.
3. Texts further from the hub than two steps of 1 - s, whose differences are most of a text, meet
   in one of the n - ceil(s * n) + 1 rarest of their own shingles; by the triangle inequality
   of the Jaccard distance they need no texts that were joined with the hub.

Null texts count as empty. One document of each component stays, the one with the smallest doc_id, a null
doc_id only if there is no other; of repeated rows one stays. An empty table gives an empty result; further
columns are left alone, whatever their names. A text is hashed in parts of bounded length; its distinct shingles
(8 bytes a word at most) are held in one row, as the text itself is.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cabrank.llm.common import saved, text_of
from cabrank.llm.components import connected
from cabrank.llm.simhash import SEED, classes_of, fingerprints, one_of_each, row_hash, word_lists

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 5
_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the shingles of a text, in order."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    digest, found, carried = xxhash.xxh64_intdigest, [], []
    for words in word_lists(data):
        words = carried + words
        if len(words) >= shingle:
            whole = zip(*(words[i:] for i in range(shingle)))
            found.append(np.unique(np.array([digest(b" ".join(s), SEED) for s in whole], np.uint64)))
        carried = words[max(0, len(words) - shingle + 1) :]
    return np.unique(np.concatenate(found)) if found else np.array([digest(b" ".join(carried), SEED)], np.uint64)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band of minimum hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[at : at + 4096, None] * FACTORS + SHIFTS).min(axis=0), out=least)
    return np.array([xxhash.xxh64_intdigest(band.tobytes()) for band in least.reshape(BANDS, ROWS)], np.uint64).view(np.int64)


def hashed_shingles(shingle: int) -> Callable[[Column], Column]:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, shingle).view(np.int64) for t in texts])

    return hashes


def keys(shingle: int) -> Callable[[Column], Column]:
    """The keys of the bands."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def numbers(texts: pd.Series) -> pd.Series:
        return pd.Series([band_keys(shingles(t, shingle)) for t in texts])

    return numbers


def _node() -> Column:
    return F.unhex(F.md5(text_of()))


def _sets(documents: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node and its shingles, for the given nodes."""
    texts = documents.select(_node().alias("node"), text_of().alias("text")).join(nodes, "node", "left_semi")
    return saved(texts.dropDuplicates(["node"]).select("node", hashed_shingles(shingle)("text").alias("set")))


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that reach the similarity."""
    shared = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(sets.toDF("a", "x"), "a")
        .join(sets.toDF("b", "y"), "b")
        .where(shared / (F.size("x") + F.size("y") - shared) >= similarity)
        .select("a", "b")
    )


def _similar_size(similarity: float) -> Column:
    return F.least("m", "n") / F.greatest("m", "n") >= similarity


def met_hubs(classes: DataFrame) -> DataFrame:
    """hub, node: every text that shares a bucket, with the hub of each of its buckets."""
    spread = classes.select("node", F.posexplode("keys").alias("band", "key"))
    full = spread.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    members = saved(spread.join(full, ["band", "key"]))
    weight = members.groupBy("node").agg(F.sum("members").alias("weight"))
    hubs = members.join(weight, "node").groupBy("band", "key").agg(F.max(F.struct("weight", "node")).alias("top"))
    pairs = members.join(hubs, ["band", "key"]).select(F.col("top.node").alias("hub"), "node")
    return saved(pairs.where("hub != node").distinct())


def _prefixes(tokens: DataFrame) -> DataFrame:
    """The rarest tokens (region, key, token) of each key of a region, as many as ``short`` or ``long`` ask for."""
    often = tokens.groupBy("region", "token").agg(F.count("*").alias("often")).where("often > 1")
    rarest = Window.partitionBy("region", "key").orderBy("often", "token")
    # Tokens without ``often`` are of one text alone: they take the first places and meet nothing.
    placed = tokens.join(often, ["region", "token"], "left").withColumn("place", F.row_number().over(rarest))
    return placed.where((F.col("place") <= F.greatest("short", "long")) & F.col("often").isNotNull()).drop("often")


def apart(measured: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (a, b) of different components that met the same hub.

    ``measured`` has hub, node, m and n (their numbers of shingles) and alike (their similarity). Tokens carry
    64-bit hashes of names; equal hashes of different names only make more candidates.
    """
    of_node, of_hub = roots.toDF("node", "root"), roots.toDF("hub", "hub_root")
    rows = measured.join(of_node, "node", "left").join(of_hub, "hub", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node")).withColumn("hub_root", F.coalesce("hub_root", "hub"))
    rows = rows.withColumn("far", F.col("alike") < 2 * similarity - 1 - 1e-9).withColumn("apart", F.col("alike") < similarity)
    near_open = F.col("apart") & ~F.col("far") & (F.col("root") != F.col("hub_root"))
    held = rows.groupBy("hub").agg(
        F.count_if(near_open).alias("open_near"), F.count_if("far").alias("open_far"),
        F.count_if(~F.col("far")).alias("near"), F.count_if("apart").alias("unlinked"),
    )
    rows = saved(rows.join(held, "hub").withColumn("open", near_open))
    names = [F.xxhash64("node").alias("key"), F.xxhash64("root").alias("root"), "n"]

    both = rows.where("NOT far AND open_near > 0 AND near > 1").join(sets.toDF("node", "y"), "node").join(sets.toDF("hub", "x"), "hub")
    difference = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
    # What a text shares with one that the hub was not joined to is more than half of this.
    half = F.floor((F.size("own") + (F.col("m") - F.col("n")) * (1 - similarity) / (1 + similarity)) / 2 - 1e-6)
    whole = F.floor(F.col("n") * (1 - similarity) / similarity + 1e-6) + 1
    by_difference = both.withColumn("own", difference).select(
        F.xxhash64("hub").alias("region"), *names, (F.size("own") - half).cast("long").alias("short"),
        F.when(F.col("open"), whole).otherwise(0).cast("long").alias("long"), F.size("own").alias("size"), F.explode("own").alias("token"),
    )
    # A little below the bound, so that rounding does not shorten a prefix.
    prefix = (F.col("n") - F.ceil(F.col("n") * similarity - 1e-6) + 1).cast("long")
    distant = rows.where("apart AND open_far > 0 AND unlinked > 1").groupBy("node", "root", "n").agg(F.max("far").alias("far"))
    # All of these are one region, whatever their hub: their own shingles are the same beside any.
    by_text = distant.join(sets, "node").select(
        F.lit(0).cast("long").alias("region"), *names, prefix.alias("short"),
        F.when(F.col("far"), prefix).otherwise(0).alias("long"), F.size("set").alias("size"), F.explode("set").alias("token"),
    )
    tokens = saved(_prefixes(saved(by_difference.unionByName(by_text))))
    own = ["key", "root", "n", "size", "place"]
    one = tokens.where("place <= long").select("region", "token", *own).toDF("region", "token", "a", "r", "m", "other_size", "other_place")
    other = tokens.where("place <= short").select("region", "token", *own).withColumnRenamed("key", "b")
    # At the first token two texts share, they can have it and what is left of either in common; alike ones need that many.
    left = 1 + F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    needed = (F.col("size") + F.col("other_size") - (F.col("m") + F.col("n")) * (1 - similarity) / (1 + similarity)) / 2
    met = one.join(other, ["region", "token"]).where((F.col("r") != F.col("root")) & _similar_size(similarity) & (left >= needed - 1e-6))
    pairs = met.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    called = sets.select(F.xxhash64("node").alias("key"), "node")
    return pairs.join(called.toDF("x", "a"), "x").join(called.toDF("y", "b"), "y").select("a", "b")


def links(documents: DataFrame, classes: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of nodes of ``classes`` (node, keys) that join all texts of a component."""
    pairs = met_hubs(classes)
    sets = _sets(documents, pairs.select(F.col("hub").alias("node")).union(pairs.select("node")).distinct(), shingle)
    shared = F.size(F.array_intersect("x", "y"))
    measured = pairs.join(sets.toDF("hub", "x"), "hub").join(sets.toDF("node", "y"), "node")
    measured = saved(measured.select("hub", "node", F.size("x").alias("m"), F.size("y").alias("n"), (shared / (F.size("x") + F.size("y") - shared)).alias("alike")))
    found = measured.where(F.col("alike") >= similarity).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    candidates = saved(apart(measured, connected(found), sets, similarity))
    return found.union(_alike(candidates, sets, similarity))


def with_prints(rows: DataFrame) -> DataFrame:
    """node and keys of every text of ``rows`` (doc_id, node, fp, keys), with its SimHash component before the other keys."""
    prints = classes_of(rows.select("doc_id", "fp")).select("fp", "root")
    texts = rows.dropDuplicates(["node"]).select("node", "fp", "keys")
    return saved(texts.join(prints, "fp").select("node", F.concat(F.array("root"), "keys").alias("keys")))


def keep_one(documents: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns."""
    named = [_node().alias("node"), fingerprints(text_of()).alias("fp"), keys(shingle)(text_of()).alias("keys")]
    rows = saved(documents.select("doc_id", row_hash(documents).alias("content"), *named))
    roots = connected(links(documents, with_prints(rows), shingle, similarity))
    rooted = rows.drop("fp", "keys").join(roots, "node", "left").select("doc_id", "content", F.coalesce("root", "node").alias("root"))
    return one_of_each(documents, rooted)
