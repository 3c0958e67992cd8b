"""Size checks that decide how a small side is joined; results never depend on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_LIMIT = 32 * 1024 * 1024
TASK_BYTES = 256 * 1024 * 1024
ROW_GROUP_BYTES = 128 * 1024 * 1024
UNKNOWN = 2**63 - 1


def scanned_bytes(df: DataFrame) -> int | None:
    """Bytes of all inputs of a plan as Spark's own statistics give them; None when they are not known.

    Nothing is run. Leaves are added up, so this bounds the result of filters,
    projections, aggregates and key lookups, though not of a join that multiplies rows.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except AttributeError:  # a remote session has no local plan
        return None
    # Spark reports the largest long for an input whose size it cannot tell.
    return None if any(size >= UNKNOWN for size in sizes) else sum(sizes)


def fits_broadcast(*frames: DataFrame) -> bool:
    return all(fits(df, BROADCAST_LIMIT) for df in frames)


def fits(df: DataFrame, limit: int) -> bool:
    size = scanned_bytes(df)
    return size is not None and size <= limit


def lookup(df: DataFrame, limit: int | None = None) -> DataFrame:
    """A lookup table marked for broadcast when it is small; beyond the limit a shuffled join is left to Spark."""
    return F.broadcast(df) if fits(df, BROADCAST_LIMIT if limit is None else limit) else df


def output_tasks(df: DataFrame) -> int:
    """Tasks for an explicit shuffle of all rows: the session's setting, or more when the input calls for it."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, (scanned_bytes(df) or 0) // TASK_BYTES)


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle an input that is no larger than one row group, so that all cores share the work.

    A row group is read by a single task, whatever the number of splits.
    Moving so few bytes is cheap; larger inputs consist of enough row groups
    and are left as they are.
    """
    return df.repartition(*keys) if fits(df, ROW_GROUP_BYTES) else df
