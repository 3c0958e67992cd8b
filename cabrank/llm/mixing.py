r"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Of all rates between
0 and the cap that give each source its target number of words, those nearest to one
copy per document in relative entropy are exp(tilt * size), cut at the cap, with one
tilt per source. The tilts solve the convex dual: Newton steps on the logarithm of a
source's words, kept inside a bracket, all sources at once, each step one distributed
sum over the cells of the input. A cell holds the documents of one source and size, so
they share a rate; a cell with many documents is split by hash.

Rates become copies cell by cell: from the largest size down, each cell takes the whole
number of copies that brings the running total nearest to its ideal, so a source ends
within half its smallest size where its cells allow it. Within a cell the documents that come first by
hash get the odd copies. Everything depends on the rows alone, so reruns agree.

A null source is a source of its own and comes last. A null text has no words. Documents
without words keep one copy, and take nothing. Null and repeated doc_ids are fine: rows
that agree in everything share their copies in any order. An empty table gives an empty
result; further columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cabrank.llm.common import saved, spare, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
#: Documents of a cell at most, about.
CELL = 50_000
STEPS, EXACT = 60, 1e-9
#: Sources and crowded cells are broadcast up to these numbers; they are counted before.
BROADCAST_SOURCES, BROADCAST_CELLS = 50_000, 200_000


def words_of(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def source_key(name: str = "source") -> Column:
    """The source as a string that is never null; the null source sorts behind all others by ``unknown``."""
    return F.when(F.col(name).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(name)))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (key, source, source_size) with the target of each.

    Weights are dealt in the order of the names' code points. Sources whose share would exceed
    the cap stop there and the rest is shared anew: as the shares of the others only grow,
    these are the first sources by cap per weight, up to a point that running sums show. Putting
    more sources at the cap than have to be there would lower the level of the others, hence the maximum.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    order = Window.orderBy(F.col("source").isNull(), "source")
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    before = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "key").rowsBetween(0, Window.unboundedFollowing)
    level = (F.lit(share) * F.col("all_sizes") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        sources.withColumns({"weight": dealt, "all_sizes": total, "limit": F.lit(cap) * F.col("source_size")})
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(Window.partitionBy()))
        .select("key", "source_size", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), "limit")).alias("target"))
    )


def tilts(cells: DataFrame, goals: DataFrame, cap: float = CAP, steps: int = STEPS) -> DataFrame:
    """The tilt of every source: key, target, mean and tilt, where a rate is exp(tilt * size / mean).

    ``cells`` has key, size, n; ``goals`` has key, source_size, target. The driver sees one number per step.
    """
    inked = cells.where("size > 0")
    state = saved(
        inked.groupBy("key")
        .agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"), F.min("size").alias("least"))
        .join(goals, "key")
        .withColumn("mean", F.col("words") / F.col("docs"))
        .withColumn("goal", F.log(F.greatest(F.col("target"), F.lit(1e-300))))
        # Outside these bounds all rates are at the cap, or all are below what the target needs.
        .withColumn("low", F.least(F.lit(0.0), (F.col("goal") - F.log("words")) * F.col("mean") / F.col("least")))
        .withColumn("high", F.when(F.col("target") > F.col("words"), F.lit(math.log(cap)) * F.col("mean") / F.col("least")).otherwise(0.0))
        .withColumn("tilt", F.when(F.col("target") >= cap * F.col("words") * (1 - EXACT), F.col("high")).otherwise(0.0))
        .select("key", "target", "mean", "goal", "low", "high", "tilt")
    )
    few = state.count() <= BROADCAST_SOURCES
    for _ in range(steps):
        power = F.col("tilt") * F.col("size") / F.col("mean")
        mass = F.col("n") * F.col("size") * F.least(F.exp(F.least(power, F.lit(50.0))), F.lit(cap))
        slope = F.when(power < math.log(cap), mass * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            inked.join(F.broadcast(state) if few else state, "key")
            .groupBy("key")
            .agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope"))
        )
        error = F.log("mass") - F.col("goal")
        newton = F.col("tilt") - error * F.col("mass") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        done = F.abs(error) <= EXACT
        state = saved(
            state.join(sums, "key")
            .withColumns({"error": error, "low": F.when(error < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(error > 0, F.col("tilt")).otherwise(F.col("high"))})
            .withColumn("next", F.when(done | (F.col("high") <= F.col("low")), F.col("tilt")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2))
            .withColumn("moved", F.col("next") != F.col("tilt"))
            .select("key", "target", "mean", "goal", "low", "high", F.col("next").alias("tilt"), "moved")
        )
        if not state.agg(F.max("moved")).first()[0]:
            break
        state = state.drop("moved")
    return state.select("key", "target", "mean", "tilt")


def rounded(cells: pd.DataFrame, cap: float = CAP) -> pd.DataFrame:
    """Whole copies for the cells of one source: key, size, part, n, rate become key, size, part, n, copies."""
    cells = cells.sort_values(["size", "part"], ascending=[False, True])
    copies, owed = [], 0.0
    for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist()):
        if size:
            owed += n * size * rate
            taken = min(max(math.floor(owed / size + 0.5), 0), math.floor(cap * n))
            owed -= taken * size
        else:
            taken = n
        copies.append(taken)
    return cells.assign(copies=copies)[["key", "size", "part", "n", "copies"]]


def _rounded(cap: float):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        return rounded(cells, cap)

    return run


def mix(
    documents: DataFrame,
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> tuple[DataFrame, list[str]]:
    """The documents with their words, the words and target of their source, and their copies.

    Returns the frame and the names of these four columns, which avoid those of the documents.
    """
    size = words_of() if size is None else size
    names = spare(documents, "size", "source_size", "target", "copies")
    key, order, part, place = spare(documents, *(f"mix_{n}" for n in ("key", "order", "part", "place")))
    content = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in documents.columns])
    sized = documents.select("*", size.alias(names[0]), source_key().alias(key), content.alias(order))
    plain = saved(sized.select(F.col(key).alias("key"), "source", F.col(names[0]).alias("size"), F.col(order).alias("order")))

    cells = saved(plain.groupBy("key", "source", "size").agg(F.count("*").alias("n")))
    sources = cells.groupBy("key", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = saved(targets(sources, weights, share, cap))
    tilted = tilts(cells, goals, cap)
    crowded = saved(cells.where(F.col("n") > CELL).select("key", "size", F.ceil(F.col("n") / CELL).alias("parts")))

    # One row for at least CELL documents, so mostly none; rows then need not be moved to find their part.
    listed = F.broadcast(crowded) if crowded.count() <= BROADCAST_CELLS else crowded

    def parted(rows: DataFrame, key: str, size: str, order: str, part: str) -> DataFrame:
        parts = listed.toDF(key, size, part)
        return rows.join(parts, [key, size], "left").withColumn(part, F.coalesce(F.pmod(order, part), F.lit(0).cast("long")))

    rate = F.least(F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(cap))
    counted = (
        parted(plain, "key", "size", "order", "part")
        .groupBy("key", "size", "part")
        .agg(F.count("*").alias("n"))
        .join(tilted, "key", "left")
        .select("key", "size", "part", "n", F.coalesce(rate, F.lit(1.0)).alias("rate"))
    )
    dealt = counted.groupBy("key").applyInPandas(_rounded(cap), "key string, size long, part long, n long, copies long")
    dealt = saved(dealt.join(goals, "key").select("key", "size", "part", "n", "copies", "source_size", "target"))

    inner = Window.partitionBy(key, names[0], part).orderBy(order)
    shares = dealt.select(
        F.col("key").alias(key), F.col("size").alias(names[0]), F.col("part").alias(part),
        F.struct("n", "copies", "source_size", "target").alias(place),
    )
    odd = F.row_number().over(inner) <= F.col(f"{place}.copies") % F.col(f"{place}.n")
    frame = (
        parted(sized, key, names[0], order, part)
        .join(shares, [key, names[0], part])
        .withColumn(names[3], F.floor(F.col(f"{place}.copies") / F.col(f"{place}.n")) + odd.cast("long"))
        .withColumns({names[1]: F.col(f"{place}.source_size"), names[2]: F.col(f"{place}.target")})
        .select(*documents.columns, *names)
    )
    return frame, names


def taken(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    rows = saved(documents.select("doc_id", "source", words_of().alias("words")))
    frame, (size, source_size, target, copies) = mix(rows, F.col("words"), **options)
    return frame.select(
        "doc_id", F.col(size).alias("size"), F.col(source_size).alias("source_size"), F.col(target).alias("target"),
        F.col(copies).alias("copies"), (F.col(copies) * F.col(size)).alias("taken"),
    )


def mixture(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    frame, (_, _, _, copies) = mix(documents, **options)
    return frame.where(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(documents.columns)
