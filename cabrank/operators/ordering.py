"""Sorts, top-k, layout and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cabrank.functions import codes, columns as c
from cabrank.operators.sizing import output_tasks


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of an order. Each task keeps k rows; end the order with a unique key."""
    return df.orderBy(*order).limit(k)


def rank_of(column: Column | str, names: list[str]) -> Column:
    """Position of a value in a list, for report orders that are not alphabetical."""
    return c.label(column, {name: i for i, name in enumerate(names, start=1)}, len(names) + 1)


def band_order(band: Column | str = "distance_band") -> Column:
    return rank_of(band, list(codes.DISTANCE_BANDS.values()))


def day_part_order(part: Column | str = "time_period") -> Column:
    return rank_of(part, list(codes.DAY_PARTS))


def monday_first(name: Column | str = "day_name") -> Column:
    days = list(codes.DAY_NAMES.values())
    return rank_of(name, days[1:] + days[:1])


def value_at_max(df: DataFrame, value: str, by: str, name: str) -> DataFrame:
    """The value whose measure is the largest, without a sort; ties go to the smaller value."""
    best = df.agg(F.max(by).alias("_best"))
    return df.crossJoin(F.broadcast(best)).filter(F.col(by) == F.col("_best")).agg(F.min(value).alias(name))


def sort_for_layout(df: DataFrame, order: str = "pickup_datetime", files: int | None = None) -> DataFrame:
    """Rows laid out by range, so files hold disjoint periods and scans can skip most of them.

    Equal times are spread over files by a hash, so one crowded moment does not end up in one task.
    """
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(files or output_tasks(df), order, spread).sortWithinPartitions(order)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A random sample of at most n rows: the first by a hash of the key and the seed, so reruns agree.

    Rows that share a key have the same hash; all columns then decide.
    """
    drawn = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed)).cast("binary"))
    return df.orderBy(drawn, *df.columns).limit(n)
