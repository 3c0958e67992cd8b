"""Unions of trip sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_common(*frames: DataFrame) -> DataFrame:
    """Only the columns all inputs share, in the order of the first input."""
    shared = [n for n in frames[0].columns if all(n in f.columns for f in frames[1:])]
    return reduce(DataFrame.unionByName, [f.select(*shared) for f in frames])


def union_all_columns(*frames: DataFrame) -> DataFrame:
    """All columns of any input; null where an input lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_types(yellow: DataFrame, green: DataFrame) -> DataFrame:
    """Yellow and green trips of the same layout in one frame."""
    return yellow.unionByName(green)
