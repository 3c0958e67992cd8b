"""Near duplicates by SimHash: 64-bit fingerprints, found by blocks of equal bits.

Texts are lower-cased (A-Z), split into words at blanks and cut into shingles of
three words; a bit of the fingerprint is 1 if more than half of the shingle
hashes have it. Equal fingerprints are one class, so copies never meet in a join.

Two fingerprints that differ in at most ``distance`` bits agree in all but
``distance`` of any blocks the bits are cut into. Classes that agree in such a
choice of blocks meet in a bucket and are compared. A bucket with more members
than ``CROWD`` is cut again, in the bits that are not fixed by it, into pieces of
two bits; the buckets of the second cut leave only 2 * distance bits open, so they
hold at most 4 ** distance classes. The number of compared pairs is therefore
linear in the number of classes, and no link is lost.

Null texts count as empty; a text without words has fingerprint zero and is
linked like any other. A null doc_id is never the smallest of a component, unless
all are null. Repeated rows share a component. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cabrank.llm.common import saved, spare, text_of
from cabrank.llm.components import connected

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = 4
CROWD = 32
#: Bytes of a text that are split into words at a time.
PART = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"


def word_lists(data: bytes, part: int = PART) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded length; no word is cut."""
    start = 0
    while start < len(data):
        end = min(start + part, len(data))
        while end < len(data) and data[end] not in BLANKS:
            end += 1
        yield data[start:end].split()
        start = end


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number."""
    # bytes.lower and bytes.split know ASCII only, which is what is asked for.
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    ones, total, carried = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_lists(data):
        words = carried + words
        if len(words) >= SHINGLE:
            shingles = zip(*(itertools.islice(words, i, None) for i in range(SHINGLE)))
            hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], np.uint64)
            for at in range(0, len(hashes), 65536):
                bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carried = words[-(SHINGLE - 1) :]
    if not total:
        return digest(b" ".join(carried), SEED) if carried else 0
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def open_masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks of the bits left open when all but ``distance`` of the blocks of ``bits`` must agree."""
    parts = [sum(1 << bits[i] for i in range(len(bits) * k // blocks, len(bits) * (k + 1) // blocks)) for k in range(blocks)]
    return [sum(chosen) for chosen in itertools.combinations(parts, distance)]


def finer(mask: int, distance: int) -> list[int]:
    """Open masks of the second cut, which cuts the bits left open by the first into pairs."""
    bits = [i for i in range(64) if mask >> i & 1]
    return open_masks(bits, len(bits) // 2, distance)


def links(classes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """Pairs a < b of the fingerprints in column ``fp`` (distinct) that differ in at most ``distance`` bits."""
    masks = open_masks(list(range(64)), blocks, distance)
    inner = [(signed(m), signed(o)) for m in masks for o in finer(m, distance)]
    rest = F.col("fp").bitwiseAND(F.bitwise_not("open")).alias("rest")

    keyed = classes.select("fp", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("open")).select("fp", "open", rest)
    bucket = Window.partitionBy("open", "rest")
    members = saved(keyed.withColumn("members", F.count("*").over(bucket)).where("members > 1"))

    def compared(rows: DataFrame) -> DataFrame:
        """Pairs of one bucket; no bucket has more members than ``crowd`` or 4 ** distance."""
        others = rows.select("open", "rest", F.col("fp").alias("b"))
        return (
            rows.select("open", "rest", F.col("fp").alias("a"))
            .join(others, ["open", "rest"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
            .select("a", "b")
        )

    # A constant table: the second cuts of each first cut. Different first cuts may share a second one.
    cuts = classes.sparkSession.createDataFrame(inner, "first long, open long")
    crowded = members.where(F.col("members") > crowd).select("fp", F.col("open").alias("first"))
    again = crowded.join(F.broadcast(cuts), "first").select("fp", "open", rest).distinct()
    return compared(members.where(F.col("members") <= crowd)).union(compared(again)).distinct()


def classes_of(rows: DataFrame) -> DataFrame:
    """Every fingerprint of ``rows`` (doc_id, fp) with the smallest fingerprint (root) and doc_id of its component."""
    classes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected(links(classes))
    rooted = saved(
        classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    )
    least = saved(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return saved(rooted.join(least, "root").select("fp", "root", "component_id"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp (fingerprint as a long), component_id (its smallest doc_id)."""
    rows = saved(documents.select("doc_id", fingerprints(text_of()).alias("fp")))
    return rows.join(classes_of(rows), "fp").select("doc_id", "fp", "component_id")


def row_hash(documents: DataFrame) -> Column:
    """A hash of all columns, which tells rows with the same doc_id apart."""
    return F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in documents.columns])


def one_of_each(documents: DataFrame, rooted: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each root of ``rooted`` (doc_id, content, root), with its own columns."""
    content, place = spare(documents, "content", "place")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "content")).alias("least")
    kept = saved(rooted.groupBy("root").agg(least).select("least.doc_id", F.col("least.content").alias(content)))
    left = documents.withColumn(content, row_hash(documents)).alias("d")
    same = F.col(f"d.{content}").eqNullSafe(F.col(f"k.{content}")) & F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    repeated = Window.partitionBy("doc_id", content).orderBy(F.lit(0))
    return (
        left.join(kept.alias("k"), same, "left_semi")
        .withColumn(place, F.row_number().over(repeated))
        .where(F.col(place) == 1)
        .select(documents.columns)
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns.

    Rows are told apart by doc_id and a hash of all columns, so one row stays even
    where doc_ids repeat or are null.
    """
    rows = saved(documents.select("doc_id", row_hash(documents).alias("content"), fingerprints(text_of()).alias("fp")))
    return one_of_each(documents, rows.join(classes_of(rows), "fp"))
