"""Grouped aggregates, conditional counts, shares and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cabrank.functions import columns as c


def rows(name: str = "trip_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def mean(column: Column | str, name: str) -> Column:
    return F.avg(column).alias(name)


def total(column: Column | str, name: str) -> Column:
    return F.sum(column).alias(name)


def distinct(column: Column | str, name: str, approximate: bool = False) -> Column:
    """Exact distinct count; HyperLogLog on request."""
    return (F.approx_count_distinct(column) if approximate else F.countDistinct(column)).alias(name)


def distinct_places(column: str, name: str) -> Column:
    """Exact distinct count of a column that a lookup table or code list bounds, such as location ids.

    The set is no larger than the lookup, so several of them share one pass, while
    ordinary distinct counts copy every row once per column.
    """
    return F.size(F.collect_set(column)).cast("bigint").alias(name)


def distinct_days(column: Column | str, name: str) -> Column:
    """Exact distinct count of dates, of which a calendar bounds the number; several share one pass."""
    return F.size(F.collect_set(column)).cast("bigint").alias(name)


def count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def spread(column: Column | str, name: str, ddof: int = 1) -> Column:
    """Standard deviation of a sample (ddof=1, null for one row) or of a population (ddof=0)."""
    return (F.stddev_samp(column) if ddof else F.stddev_pop(column)).alias(name)


def group_agg(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggregates)


def group_by_expr(df: DataFrame, name: str, expression: Column, keys: list[str], *aggregates: Column) -> DataFrame:
    """Group by a derived label and further columns."""
    return df.withColumn(name, expression).groupBy(name, *keys).agg(*aggregates)


def having(grouped: DataFrame, min_count: int, count: str = "trip_count") -> DataFrame:
    """Only groups with at least ``min_count`` rows."""
    return grouped.filter(F.col(count) >= min_count)


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """100 * part / whole, null for an empty whole."""
    value = F.try_divide(part * F.lit(100.0), whole)
    return value if digits is None else c.rounded(value, digits)


def share_of_total(
    grouped: DataFrame, column: str, name: str, by: list[str] | None = None, digits: int | None = 2
) -> DataFrame:
    """Percent of a partition or of everything. Input is an aggregate: one row per group, not raw rows."""
    whole = F.sum(column).over(Window.partitionBy(*(by or [])))
    return grouped.withColumn(name, percent(F.col(column), whole, digits))


def value_counts(df: DataFrame, column: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(column).agg(rows(name)).orderBy(F.desc(name), column)


def pivot(
    df: DataFrame, index: str, column: str, names: list, aggregate: Column, fill: float | int | None = None
) -> DataFrame:
    """One column per listed value. Listing the values saves the extra pass that would find them."""
    wide = df.groupBy(index).pivot(column, names).agg(aggregate)
    return wide if fill is None else wide.fillna(fill, [str(n) for n in names])


def first_last(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """First start and last end of a group."""
    return df.groupBy(*keys).agg(F.min(start).alias(f"first_{start}"), F.max(end).alias(f"last_{end}"))


def two_level(
    df: DataFrame, inner_keys: list[str], inner: list[Column], outer_keys: list[str], outer: list[Column]
) -> DataFrame:
    """Aggregate of an aggregate."""
    return df.groupBy(*inner_keys).agg(*inner).groupBy(*outer_keys).agg(*outer)


# --- decomposed averages ----------------------------------------------------
# Averages that are first taken per fine key and then merged: sums and counts
# travel, so a hot coarse key is already reduced when it is shuffled.


def partial_sums(*columns: str) -> list[Column]:
    return [
        agg
        for name in columns
        for agg in (F.sum(name).alias(f"_sum_{name}"), F.count(name).alias(f"_cnt_{name}"))
    ]


def merged_mean(column: str, name: str, weight: Column | None = None) -> Column:
    weight = F.lit(1) if weight is None else weight
    return F.try_divide(
        F.sum(F.col(f"_sum_{column}") * weight), F.sum(F.col(f"_cnt_{column}") * weight)
    ).alias(name)


def place_cells(trips: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """Trips reduced to one row per group and pair of places: counts, and sums of the columns in mergeable form."""
    return trips.groupBy(*keys, "pickup_location_id", "dropoff_location_id").agg(rows("_n"), *partial_sums(*columns))


# --- distinct ids that can be merged ----------------------------------------
# Ids without a bound are no set that fits a row, and ordinary distinct counts copy every row for each
# column. Bitmaps hold the ids of one range each: they are built where the rows are, travel with
# the sums and are united wherever groups are merged.


def id_cells(df: DataFrame, keys: list, ids: list[str], *partials: Column) -> DataFrame:
    """Partial results per group and range of each integer id column, with bitmaps of the ids (_bits_...)."""
    ranges = [F.bitmap_bucket_number(F.col(i).cast("bigint")).alias(f"_range_{i}") for i in ids]
    bits = [F.bitmap_construct_agg(F.bitmap_bit_position(F.col(i).cast("bigint"))).alias(f"_bits_{i}") for i in ids]
    return df.groupBy(*keys, *ranges).agg(*partials, *bits)


def merged_ids(cells: DataFrame, keys: list[str], ids: dict[str, str], *aggregates: Column) -> DataFrame:
    """Groups of the cells of ``id_cells``: exact distinct counts (name -> id column) and merged partial results.

    Partial results are the columns that begin with an underscore, other than ranges and bitmaps; they are added up.
    """
    sums = [c for c in cells.columns if c.startswith("_") and not c.startswith(("_range_", "_bits_")) and c not in keys]
    entries = [
        F.struct(
            F.lit(i).alias("_id"), F.col(f"_range_{column}").alias("_range"), F.col(f"_bits_{column}").alias("_bits"),
            *[(F.col(s) if i == 0 else F.lit(None).cast(cells.schema[s].dataType)).alias(s) for s in sums],
        )
        for i, column in enumerate(ids.values())
    ]
    united = cells.select(*keys, F.inline(F.array(*entries))).groupBy(*keys, "_id", "_range").agg(
        F.bitmap_or_agg("_bits").alias("_bits"), *[F.sum(s).alias(s) for s in sums]
    )
    counts = [
        F.coalesce(F.sum(F.when(F.col("_id") == i, F.bitmap_count("_bits"))), F.lit(0)).cast("bigint").alias(name)
        for i, name in enumerate(ids)
    ]
    return united.groupBy(*keys).agg(*aggregates, *counts)


def growth_percent(now: Column, before: Column, digits: int = 2) -> Column:
    """Change against the previous value in percent; null without one or when it is zero."""
    return c.rounded(c.ratio((now - before) * F.lit(100.0), before), digits)
