"""Exact duplicates by digest, with the frequent digests taken out of the shuffle.

A Misra-Gries summary per partition and the sum of all summaries name the
digests that may be frequent; one more pass counts those exactly and finds the
row that stays. These few winners are broadcast, so copies of frequent texts are
settled where they are read. Only the other digests are shuffled, and none of
their groups can hold more than 2 / (counters + 1) of all rows.

Null texts count as empty. Of equal texts the row with the largest doc_id stays;
a null doc_id is smaller than any other, and of repeated rows exactly one stays.
An empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from cabrank.llm.common import saved, spare, text_of

#: Counters of a summary: also the most rows that are ever broadcast.
COUNTERS = 256


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the text and a number that tells repeated rows apart; computed once."""
    return saved(
        documents.select(
            "doc_id",
            F.unhex(F.sha2(text_of(), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def summarise(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries over one partition, a batch at a time: no count is more than rows / (counters + 1) too low."""
    held: dict[bytes, int] = {}
    for batch in batches:
        counted = pc.value_counts(batch.column(0))
        for digest, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist()):
            held[digest] = held.get(digest, 0) + n
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {digest: n - cut for digest, n in held.items() if n > cut}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "seen"]
    )


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The frequent digests of (doc_id, digest, row): exact group size and the row that stays; at most ``counters`` rows.

    Every digest with more than 2 / (counters + 1) of the rows is among them: its
    summed count then exceeds 1 / (counters + 1) of the rows, and so can no more
    than ``counters`` others.
    """
    summaries = rows.select("digest").mapInArrow(lambda batches: summarise(batches, counters), "digest binary, seen long")
    candidates = (
        summaries.groupBy("digest").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "digest").limit(counters)
    )
    return saved(
        rows.join(F.broadcast(candidates.select("digest")), "digest")
        .groupBy("digest")
        .agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("doc_id", (-F.col("row")).alias("earlier"))).alias("winner"),
        )
        .where("group_size > 1")
        .select("digest", "group_size", F.col("winner.doc_id").alias("keep_id"), (-F.col("winner.earlier")).alias("keep_row"))
    )


def decisions(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept."""
    rows = digests(documents)
    heavy = frequent(rows, counters)
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    columns = ["doc_id", "digest", "keep_id", "group_size", "kept"]
    settled = marked.where("group_size IS NOT NULL").withColumn("kept", F.expr("row = keep_row")).select(columns)
    group = (
        Window.partitionBy("digest")
        .orderBy(F.desc_nulls_last("doc_id"), "row")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    shuffled = (
        marked.where("group_size IS NULL")
        .select("doc_id", "digest", "row")
        .withColumns(
            {
                "keep_id": F.first("doc_id").over(group),
                "group_size": F.count("*").over(group),
                "kept": F.col("row") == F.first("row").over(group),
            }
        )
        .select(columns)
    )
    return settled.unionByName(shuffled)


def keep_one(documents: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with their own columns; copies of frequent texts are dropped before the shuffle."""
    heavy = frequent(digests(documents), counters).select("digest", "keep_id", F.lit(True).alias("frequent"))
    digest, keep_id, found, order, place = spare(documents, "digest", "keep_id", "frequent", "order", "place")
    heavy = heavy.toDF(digest, keep_id, found)
    left = (
        documents.withColumn(digest, F.unhex(F.sha2(text_of(), 256)))
        .join(F.broadcast(heavy), digest, "left")
        .where(F.col(found).isNull() | F.col("doc_id").eqNullSafe(F.col(keep_id)))
        .withColumn(order, F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in documents.columns]))
    )
    first = Window.partitionBy(digest).orderBy(F.desc_nulls_last("doc_id"), order)
    return left.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(documents.columns)
