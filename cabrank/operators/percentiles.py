"""Exact percentiles (linear interpolation) by brackets, also for groups larger than a task's memory.

Spark's ``percentile`` keeps all distinct values of a group in one map, which no
check of the input can bound. Here a first pass takes the ordinary aggregates and a
quantile sketch of each group, which gives every wanted rank a bracket: two values it lies between.
A second pass counts the values around the brackets, which leaves a few numbers of each task, and shuffles only the values
inside them, about 2 * MARGIN / ACCURACY of a group for each percentile. The numbers around a bracket tell
the exact ranks of the values inside. A sketch that errs by more than it promises would miss a rank; that is seen
in the counts, and the group is counted again with all its values inside.

Both passes run when the function is called; what they leave is one row per group, kept in the shared folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cabrank.operators import sizing
from cabrank.sources import storage

Specs = dict[str, tuple[str, float]]

#: A sketch is off by one rank in so many.
ACCURACY = 4_000
#: How many times that error a bracket reaches to either side.
MARGIN = 2


def grouped(
    df: DataFrame,
    keys: list[str],
    aggregates: list[Column],
    percentiles: Specs,
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
) -> DataFrame:
    """Group by ``keys`` with ordinary aggregates and exact percentiles.

    ``percentiles`` maps a result name to (column, fraction). A group without any value has no percentile.
    """
    reach = margin / accuracy
    columns = sorted({column for column, _ in percentiles.values()})
    wanted = {column: [(name, p) for name, (of, p) in percentiles.items() if of == column] for column in columns}
    sketches = []
    for column, specs in wanted.items():
        edges = [min(max(p + side * reach, 0.0), 1.0) for _, p in specs for side in (-1, 1)]
        sketches.append(F.percentile_approx(F.col(column).cast("double"), edges, accuracy).alias(f"_q_{column}"))
    plain = [F.count(F.lit(1)).alias("_rows"), *aggregates]
    groups = storage.kept(df.groupBy(*keys).agg(*plain, *sketches))
    small = groups.count() * (64 + 16 * len(percentiles)) <= sizing.BROADCAST_LIMIT

    found = storage.kept(_located(df, groups.select(*keys, *[f"_q_{c}" for c in columns]), keys, wanted, small))
    missed = found.filter("_missed > 0")
    if not missed.isEmpty():
        everything = [
            F.array(*[F.lit(x) for _ in specs for x in (-math.inf, math.nan)]).alias(f"_q_{column}") for column, specs in wanted.items()
        ]
        wide = _located(df, missed.select(*keys, *everything), keys, wanted, small)
        found = found.filter("_missed = 0").unionByName(storage.kept(wide))

    values = found.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *percentiles)
    # A group without any value has aggregates but no percentile, hence the left join.
    joined = groups.join(F.broadcast(values) if small else values, _same(keys, "_key_"), "left")
    return joined.select(*keys, *[c for c in groups.columns if c not in (*keys, "_rows") and not c.startswith("_q_")], *percentiles)


def _same(keys: list[str], prefix: str) -> Column:
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return matched


def counted(df: DataFrame, brackets: DataFrame, keys: list[str], wanted: dict[str, list], small: bool) -> DataFrame:
    """Rows per group, measure and cell (keys, _m, _c, _n); inside a bracket also per value (_v, null outside).

    The cells of a measure are the stretches between the ends of its brackets, numbered in the order of the values.
    """
    edges = brackets.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[f"_q_{column}" for column in wanted])
    measures = {column: f"_v_{i}" for i, column in enumerate(wanted)}
    values = df.select(*keys, *[F.col(column).cast("double").alias(name) for column, name in measures.items()])
    # One row where there are no keys.
    both = values.join(F.broadcast(edges) if small or not keys else edges, _same(keys, "_key_"))
    entries = []
    for i, (column, specs) in enumerate(wanted.items()):
        value, ends = F.col(measures[column]), F.col(f"_q_{column}")
        entered = sum(((ends[2 * j] <= value).cast("int") for j in range(len(specs))), F.lit(0))
        left = sum(((ends[2 * j + 1] < value).cast("int") for j in range(len(specs))), F.lit(0))
        cell = F.when(value.isNotNull(), entered + left)
        entries.append(F.struct(F.lit(i).alias("_m"), cell.alias("_c"), F.when(entered > left, value).alias("_v")))
    cells = both.select(*keys, F.inline(F.array(*entries))).filter("_c IS NOT NULL")
    return cells.groupBy(*keys, "_m", "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))


def _located(df: DataFrame, brackets: DataFrame, keys: list[str], wanted: dict[str, list], small: bool) -> DataFrame:
    """The percentiles of every group that has values, and how many wanted ranks lie outside their brackets (_missed)."""
    measure = Window.partitionBy(*keys, "_m")
    running = measure.orderBy("_c", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted(df, brackets, keys, wanted, small).withColumns(
        {"_start": F.sum("_n").over(running) - F.col("_n"), "_total": F.sum("_n").over(measure)}
    )

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_n"))

    ends, missed = [], F.lit(False)
    for i, specs in enumerate(wanted.values()):
        own = F.col("_m") == i
        for name, p in specs:
            at = F.lit(float(p)) * (F.col("_total") - 1)
            low, high = own & holds(F.floor(at)), own & holds(F.ceil(at))
            missed = missed | ((low | high) & F.col("_v").isNull())
            ends += [
                F.max(F.when(low, F.col("_v"))).alias(f"_low_{name}"), F.max(F.when(high, F.col("_v"))).alias(f"_high_{name}"),
                F.max(F.when(own, at - F.floor(at))).alias(f"_part_{name}"),
            ]
    rows = placed.groupBy(*keys).agg(*ends, F.count_if(missed).alias("_missed"))

    def value(name: str) -> Column:
        part = F.col(f"_part_{name}")
        return ((1 - part) * F.col(f"_low_{name}") + part * F.col(f"_high_{name}")).alias(name)

    return rows.select(*keys, *[value(name) for specs in wanted.values() for name, _ in specs], "_missed")


def approximate(df: DataFrame, keys: list[str], percentiles: Specs, accuracy: int = 10_000) -> DataFrame:
    """Sketch-based percentiles: one pass and bounded memory, an element near the wanted rank."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(column, p, accuracy).alias(name) for name, (column, p) in percentiles.items()]
    )


def rank_error(accuracy: int, rows: int) -> int:
    """Largest distance in ranks between an approximate and the exact percentile."""
    return math.ceil(rows / accuracy)
