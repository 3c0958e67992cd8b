"""Joins to lookups, time-bucketed joins and reference checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cabrank.functions import columns as c
from cabrank.operators import sizing
from cabrank.operators.sizing import lookup
from cabrank.sources.storage import kept

# Columns whose values come from a fixed code list.
CODE_COLUMNS = {"trip_type", "payment_type", "rate_code_id", "vendor_id", "store_and_fwd_flag"}

#: Entries a code list may have to be broadcast without a look at its bytes.
MOST_CODES = 10_000

#: Crowded keys of a join at most, and the keys a sketch follows to find them.
MOST_CROWDED, TRACKED_KEYS = 1024, 100_000
#: Types of keys the sketch can count.
COUNTABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)

#: Rows of one key and bucket of time, on either side, above which they are dealt to parts of about this many.
CELL_ROWS = 4096
#: Crowded keys and buckets up to this number are broadcast.
MOST_CELLS = 100_000


def _zone_side(zones: DataFrame, side: str, with_service: bool = True) -> DataFrame:
    names = {"borough": f"{side}_borough", "zone": f"{side}_zone", "service_zone": f"{side}_service_zone"}
    if not with_service:
        names.pop("service_zone")
    return zones.select(
        F.col("location_id").alias(f"_{side}_id"), *[F.col(old).alias(new) for old, new in names.items()]
    )


def add_zone(trips: DataFrame, zones: DataFrame, side: str, how: str = "inner") -> DataFrame:
    """Borough, zone and service zone of the pickup or dropoff location."""
    names = lookup(_zone_side(zones, side))
    return trips.join(names, F.col(f"{side}_location_id") == F.col(f"_{side}_id"), how).drop(f"_{side}_id")


def trips_with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Both zones of every trip; a trip with an unknown location stays, with nulls."""
    return add_zone(add_zone(trips, zones, "pickup", "left"), zones, "dropoff", "left")


def inner_equi(trips: DataFrame, zones: DataFrame, both: bool = True) -> DataFrame:
    """Only trips whose pickup (and dropoff) location is known."""
    known = add_zone(trips, zones, "pickup")
    return add_zone(known, zones, "dropoff") if both else known


def crowded_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that alone fill a task, with the number of parts their rows should be dealt to: key, parts.

    One pass over the keys with a sketch of frequent items, run when this is called. No more than ``MOST_CROWDED`` keys can
    have a share above one in ``MOST_CROWDED``, so the result is small whatever the input; with more tasks than that, only
    keys above this share are told. The sketch's counts are estimates; every key it tells has rows.
    """
    share = 1 / min(sizing.output_tasks(df), MOST_CROWDED)
    names = df.select(F.col(key).alias("_key")).filter("_key IS NOT NULL")
    counted = names.agg(F.count("*").alias("all"), F.expr(f"approx_top_k(_key, {MOST_CROWDED}, {TRACKED_KEYS})").alias("top"))
    counts = counted.select("all", F.explode("top").alias("top")).select(
        F.col("top.item").alias(key), F.ceil(F.col("top.count") / (F.col("all") * share)).alias("parts")
    )
    return kept(counts.filter("parts > 1"))


def left_outer(left: DataFrame, right: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """All left rows; an extra condition limits the matches, not the result.

    Adaptive execution splits a crowded key on the left side of an outer join, but not on the right. So right rows of a
    crowded key are dealt to several parts by the hash of the row, and left rows of such a key meet each part. A crowded key
    has matches, so the copies of its left rows that met an empty part are dropped; all other rows are joined as usual.
    Each input is read once, after one pass over the keys of the right. Rows that repeat in all columns share a part.
    """
    if condition is not None:
        right = right.filter(condition)
    if not isinstance(right.schema[key].dataType, COUNTABLE):
        alone = left.join(right.select(key).distinct(), key, "left_anti")
        return left.join(right, key, "inner").unionByName(alone, allowMissingColumns=True)
    crowded = crowded_keys(right, key)
    if crowded.isEmpty():
        return left.join(right, key, "left")

    def with_parts(df: DataFrame, part: Column) -> DataFrame:
        return df.join(F.broadcast(crowded.withColumnRenamed("parts", "_parts")), key, "left").withColumn("_part", part)

    parts = F.coalesce("_parts", F.lit(1))
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in right.schema if not isinstance(f.dataType, T.MapType)])
    met = with_parts(left, F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = with_parts(right, F.pmod(row, parts)).withColumn("_met", F.lit(True)).drop("_parts")
    return met.join(dealt, [key, "_part"], "left").filter("_parts IS NULL OR _met").drop("_part", "_parts", "_met")


def left_then_filter(left: DataFrame, right: DataFrame, key: str, condition: Column) -> DataFrame:
    """A left join whose result is filtered on the right side keeps no unmatched row: it is an inner join."""
    return left.join(right.filter(condition), key, "inner")


def hour_bucket(ts: Column | str) -> Column:
    return F.date_trunc("hour", c.col(ts)).cast("timestamp")


def time_bucket_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    how: str = "inner",
    bucket: str = "hour",
) -> DataFrame:
    """Rows that agree in the keys and fall into the same bucket of time, as one equi-join; the keys appear once.

    ``how`` is inner or left. A merge join holds all right rows of a key in memory and does not spill them. So where a key and
    bucket has more than ``CELL_ROWS`` rows on a side, these are dealt to parts by the hash of the row, and every left part meets
    every right part as a key of its own: a row is copied once for each part of the other side, which is little beside the pairs
    it gives. The crowded ones are counted when this is called. Rows that repeat in all columns share a part.

    All pairs are listed, and their number grows with the product of both sides; where only counts or sums are wanted, reduce
    both sides to the bucket first.
    """
    cell, parts = [*keys, "_bucket"], ["_left_part", "_right_part"]

    def bucketed(df: DataFrame, time: str) -> DataFrame:
        return df.withColumn("_bucket", F.date_trunc(bucket, time).cast("timestamp"))

    left, right = bucketed(left, left_time), bucketed(right, right_time)
    crowded = crowded_cells(left, right, cell)
    cells = crowded.limit(MOST_CELLS + 1).count()
    if not cells:
        return left.join(right, cell, how).drop("_bucket")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """A row takes one part of its own side and meets each part of the other."""
        row = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)])
        sizes = df.withColumn("_row", row).join(F.broadcast(crowded) if cells <= MOST_CELLS else crowded, cell, "left")
        own_part, others = F.pmod("_row", F.coalesce(f"{own}s", F.lit(1))), F.coalesce(f"{other}s", F.lit(1))
        met = F.explode(F.sequence(F.lit(0), others - 1))
        return sizes.withColumn(own, own_part).withColumn("_several", others > 1).withColumn(other, met).drop("_row", "_left_parts", "_right_parts")

    met = dealt(left, *parts)
    joined = met.join(dealt(right, *parts[::-1]).drop("_several").withColumn("_met", F.lit(True)), [*cell, *parts], how)
    # Several right parts mean that there are matches, so a left row that met an empty one is no row of its own.
    return joined.filter("NOT _several OR _met").drop("_bucket", *parts, "_several", "_met")


def crowded_cells(left: DataFrame, right: DataFrame, cell: list[str]) -> DataFrame:
    """The keys and buckets with more than ``CELL_ROWS`` rows on a side: cell, _left_parts, _right_parts (null: not crowded there)."""

    def counted(df: DataFrame, parts: str) -> DataFrame:
        known = df.select(*cell).filter(" AND ".join(f"`{key}` IS NOT NULL" for key in cell))
        rows = known.groupBy(*cell).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > CELL_ROWS)
        return rows.select(*cell, F.ceil(F.col("_rows") / CELL_ROWS).alias(parts))

    return kept(counted(left, "_left_parts").join(counted(right, "_right_parts"), cell, "full"))


def trips_at_locations(trips: DataFrame, places: DataFrame, key: str = "location_id") -> DataFrame:
    """Trips that start or end at one of the given places, once per place.

    The condition ``pickup = place OR dropoff = place`` would compare every
    trip with every place. Listing the one or two locations of a trip first
    turns it into a single equi-join, with one pass over the trips.
    """
    ends = F.array_distinct(F.array("pickup_location_id", "dropoff_location_id"))
    touched = trips.withColumn("_place", F.explode(ends))
    return touched.join(lookup(places), F.col("_place") == F.col(key)).drop("_place")


def cross_join_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a single row of statistics (the result of an aggregate without keys) to every row.

    Only one row is taken, whatever is given, so the broadcast stays that small.
    """
    return df.crossJoin(F.broadcast(one_row.limit(1)))


def stats_join_by_key(df: DataFrame, stats: DataFrame, key: str = "trip_type") -> DataFrame:
    """Attach per-key statistics, at most one row per key.

    A code column has the entries of a fixed list, so its statistics are computed first, kept and counted, and broadcast while there
    are no more than ``MOST_CODES`` of them. Any other key, or a longer list, is joined as Spark sees fit.
    """
    if key not in CODE_COLUMNS:
        return df.join(stats, key)
    stats = kept(stats)
    return df.join(F.broadcast(stats) if stats.limit(MOST_CODES + 1).count() <= MOST_CODES else stats, key)


def anti_semi_check(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows of the fact table whose key is set but not found in the dimension."""
    known = lookup(dim.select(F.col(dim_key).alias("_known")))
    return fact.filter(F.col(fact_key).isNotNull()).join(known, F.col(fact_key) == F.col("_known"), "left_anti")


def matching_rows(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    known = lookup(dim.select(F.col(dim_key).alias("_known")))
    return fact.join(known, F.col(fact_key) == F.col("_known"), "left_semi")


def map_lookup(df: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """Add one looked-up value by key; null where the key is not listed."""
    return df.join(values.select(key, value), key, "left")
