"""The prefix trie of conversations by peeling turns off their ends.

Every node of the trie is a distinct sequence of first turns (role and text); a conversation is a member of
all nodes it starts with. Each turn gets the digest of the whole sequence up to it, so equal
sequences have equal digests. Conversations that are equal as a whole are one path
with a number of members; copies never meet in a join.

Then paths are peeled from their deepest turns on. Per round, the last turns of a path that no
other path has are stripped: each of them is a node, complete with its counts, as it is discovered. What is left ends
at a turn that is shared; paths that now end at the same node are merged, and those are joined
by the conversations that ended there all along. The next round peels the merged paths. The rounds end
with the root; their number follows how often branches are nested, not the length of a conversation.

Turns are ordered by turn (null first), equal turn numbers by role and MD5 of the text; null role or text counts as empty. Rows
without conv_id are no conversation. A conversation is held in one row, as a text is elsewhere; its
texts are not, only 16 bytes a turn. Repeated rows are turns of their own. An empty table has no
root and gives no rows. Further columns are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cabrank.llm.common import saved, text_of

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations that take their first turns from the same one.
FAMILY = 20
BORROWED = 4
#: Bits of a conv_id that tell the members of one chunk apart.
CHUNK_BITS = 12
ROOT = b""


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns (digest, words): the first h of the head of its family, then its own after the first h."""
    role, text = text_of("role"), text_of("text")
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"), "turn", role.alias("role"), F.md5(text).alias("text_md5"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    own = conversations.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = saved(own.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")))
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, BORROWED - 1).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("int")
    asked = own.withColumn("head", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", h)
    first = F.when(F.col("first").isNull(), F.slice("turns", 1, 0)).otherwise(F.expr("slice(first, 1, h)"))
    rest = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return asked.join(heads, "head", "left").select("conv_id", F.concat(first, rest).alias("turns"))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def chained(digests: pd.Series) -> pd.Series:
    """For every turn the digest of the sequence up to it."""

    def chain(own: np.ndarray) -> list[bytes]:
        state, keys = hashlib.sha256(), []
        for digest in own:
            state.update(digest)
            keys.append(state.digest()[:16])
        return keys

    return pd.Series([chain(own) for own in digests])


@F.pandas_udf(T.ArrayType(T.LongType()))
def summed(words: pd.Series) -> pd.Series:
    """For every turn the words up to it."""
    return pd.Series([np.cumsum(own, dtype=np.int64) for own in words])


def end(path: str = "path") -> Column:
    """The node a path ends at."""
    return F.when(F.size(path) > 0, F.element_at(path, -1)).otherwise(F.lit(ROOT))


def member_hashes(members: DataFrame) -> DataFrame:
    """node and the SHA-256 of its conv_ids in ascending order, joined by commas.

    A chunk holds ids of one range of 2 ** CHUNK_BITS; the chunks of a node are hashed one after the other as
    they are read, so a node of any number of members needs no more memory than a chunk.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    chunks = saved(members.groupBy("node", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(ids.alias("ids")))
    parts = chunks.groupBy("node").agg(F.count("*").alias("chunks"), F.min("ids").alias("ids"))
    single = parts.where("chunks = 1").select("node", F.sha2(F.encode("ids", "utf-8"), 256).alias("ends"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])
        for batch in batches:
            for of, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if of != node:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"node": node, "ends": state.hexdigest()}], schema)
                    node, state = of, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"node": node, "ends": state.hexdigest()}], schema)

    several = chunks.join(parts.where("chunks > 1").select("node"), "node").repartition("node").sortWithinPartitions("node", "chunk")
    return single.union(several.select("node", "ids").mapInArrow(hashed, "node binary, ends string"))


def paths_of(conversations: DataFrame) -> DataFrame:
    """One row per distinct whole sequence: path, words (sums), n (members), least, ends, and counts of a node below which nothing is peeled yet."""
    rows = rebuilt(conversations)
    rows = saved(rows.select("conv_id", chained(F.col("turns.digest")).alias("path"), summed(F.col("turns.words")).alias("words")))
    members = rows.select(end().alias("node"), "conv_id")
    whole = rows.groupBy(end().alias("node")).agg(
        F.min(F.struct("conv_id", "path", "words")).alias("first"), F.count("*").alias("n")
    )
    zero = F.lit(0).cast("long")
    return whole.join(member_hashes(members), "node").select(
        "first.path", "first.words", "n", F.col("first.conv_id").alias("least"), "ends",
        zero.alias("children"), zero.alias("leaves"), zero.alias("saved"),
    )


def merged(paths: DataFrame) -> DataFrame:
    """Paths that end at the same node as one."""
    joined = paths.groupBy(end().alias("node")).agg(
        F.min(F.struct("path", "words")).alias("any"), F.max("ends").alias("ends"), F.min("least").alias("least"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
    )
    return joined.select("any.path", "any.words", "n", "least", "ends", "children", "leaves", "saved")


def kept(paths: DataFrame) -> tuple[DataFrame, int | None]:
    """The paths, numbered and kept, and the depth of the deepest; through the cache, as in ``components``, for their real size."""
    cached = paths.persist()
    depth = cached.agg(F.max(F.size("path"))).first()[0]
    rows = saved(cached.select(F.monotonically_increasing_id().alias("id"), "*"))
    cached.unpersist()
    return rows, depth


def words_to(at: Column) -> Column:
    """The words of a path up to a depth."""
    return F.when(at > 0, F.element_at("words", F.greatest(at, F.lit(1)))).otherwise(0)


def peeled(paths: DataFrame, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes below the depth to which each path is ``shared`` (id, to), and the paths up to there."""
    rows = paths.join(shared, "id", "left").withColumn("to", F.coalesce("to", F.lit(0))).withColumn("depth", F.size("path"))
    lost = F.col("depth") > F.col("to")
    own_leaves = F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long")
    rows = saved(rows.withColumn("leaves", F.when(lost, own_leaves).otherwise(F.col("leaves"))))
    at = F.col("at")
    last = at == F.col("depth")
    spent = (F.col("n") - 1) * (words_to(F.col("depth")) - words_to(at - 1))
    nodes = (
        rows.where(lost)
        .select("*", F.explode(F.sequence(F.col("to") + 1, "depth")).alias("at"))
        .select(
            F.element_at("path", at).alias("node"), F.col("least").alias("conv_id"), at.cast("long").alias("depth"),
            F.when(at > 1, F.element_at("path", F.greatest(at - 1, F.lit(1)))).otherwise(F.lit(ROOT)).alias("parent"),
            F.when(at > F.col("to") + 1, F.col("least")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"), (F.col("saved") + spent).alias("saved_tokens"),
            F.when(last, F.col("ends")).alias("ends"),
        )
    )
    rest = rows.select(
        F.expr("slice(path, 1, to)").alias("path"), F.expr("slice(words, 1, to)").alias("words"), "n", "least",
        F.when(~lost, F.col("ends")).alias("ends"), F.when(lost, 1).otherwise(F.col("children")).cast("long").alias("children"), "leaves",
        (F.col("saved") + F.when(lost, (F.col("n") - 1) * (words_to(F.col("depth")) - words_to(F.col("to")))).otherwise(0)).alias("saved"),
    )
    return nodes, rest


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths, depth = kept(paths_of(conversations))
    found = []
    while depth:
        places = saved(paths.select("id", F.posexplode("path").alias("place", "node")))
        several = places.groupBy("node").agg(F.count("*").alias("paths")).where("paths > 1").select("node")
        shared = places.join(several, "node").groupBy("id").agg((F.max("place") + 1).alias("to"))
        nodes, rest = peeled(paths, shared)
        found.append(nodes)
        paths, depth = kept(merged(rest))
    root = paths.select(
        F.lit(ROOT).alias("node"), F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends",
    )
    nodes = saved(reduce(DataFrame.unionByName, found, root))
    # Only the uppermost node of what was peeled at once has a parent in another round.
    tops = nodes.where("depth > 0 AND parent_conv_id IS NULL").drop("parent_conv_id")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    every = nodes.where("depth = 0 OR parent_conv_id IS NOT NULL").unionByName(tops.join(parents, "parent"))
    nothing = hashlib.sha256(b"").hexdigest()
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )
