"""Data-quality and load reports. Each report reads its rows once, however many columns and rules it covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cabrank.operators import aggregates as a
from cabrank.operators.sizing import lookup
from cabrank.sources import schemas


def null_profile(df: DataFrame, names=schemas.REQUIRED) -> DataFrame:
    """Null count and percent per column."""
    counts = df.agg(a.rows("_rows"), *[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    long = counts.unpivot("_rows", list(names), "column_name", "null_count")
    return long.select("column_name", "null_count", a.percent(F.col("null_count"), F.col("_rows")).alias("null_pct"))


def dataset_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        a.rows("total_trips"),
        F.min("pickup_datetime").alias("earliest_trip"),
        F.max("pickup_datetime").alias("latest_trip"),
        a.distinct_places("trip_type", "trip_types"),
        a.count_where(F.col("trip_type") == "yellow", "yellow_trips"),
        a.count_where(F.col("trip_type") == "green", "green_trips"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("fare_amount", "avg_fare"),
        a.mean("total_amount", "avg_total"),
        a.mean("tip_amount", "avg_tip"),
        a.distinct_places("pickup_location_id", "unique_pickup_zones"),
        a.distinct_places("dropoff_location_id", "unique_dropoff_zones"),
    )


def retention_report(flagged: DataFrame, kept: Column | str = "is_valid_trip") -> DataFrame:
    """Rows before and after a filter, from one pass over the flagged rows."""
    flag = F.expr(kept) if isinstance(kept, str) else kept
    counts = flagged.agg(a.rows("initial_rows"), a.count_where(flag, "kept_rows"))
    return counts.withColumn("retention_pct", a.percent(F.col("kept_rows"), F.col("initial_rows")))


def ingestion_summary(flagged: DataFrame) -> DataFrame:
    """Totals by type and validity; a row whose flag is null is neither valid nor invalid."""
    counts = flagged.agg(
        a.rows("total_records"),
        a.count_where(F.col("trip_type") == "yellow", "yellow_trips"),
        a.count_where(F.col("trip_type") == "green", "green_trips"),
        a.count_where(F.col("is_valid_trip"), "valid_trips"),
        a.count_where(~F.col("is_valid_trip"), "invalid_trips"),
    )
    return counts.select(
        F.lit("Data Ingestion Summary").alias("metric"),
        "*",
        a.percent(F.col("valid_trips"), F.col("total_records")).alias("valid_percentage"),
    )


def date_coverage(df: DataFrame) -> DataFrame:
    grouped = df.groupBy("trip_type").agg(
        F.min("pickup_date").alias("earliest_date"),
        F.max("pickup_date").alias("latest_date"),
        a.distinct("pickup_date", "unique_dates"),
    )
    return grouped.select(F.lit("Date Range Coverage").alias("metric"), "*")


def zone_reference_check(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Number of trips whose pickup or dropoff location is unknown to the lookup.

    Trips are first counted per pair of locations, so the lookups are joined to
    one row per pair and not to every trip, and both ends are checked in one pass.
    """
    ends = ("pickup", "dropoff")
    pairs = trips.groupBy(*[f"{end}_location_id" for end in ends]).agg(a.rows("_trips"))
    for end in ends:
        known = zones.select(F.col("location_id").alias(f"_{end}")).distinct()
        pairs = pairs.join(lookup(known), F.col(f"{end}_location_id") == F.col(f"_{end}"), "left")

    def unknown(end: str) -> Column:
        lost = F.col(f"{end}_location_id").isNotNull() & F.col(f"_{end}").isNull()
        return F.coalesce(F.sum(F.when(lost, F.col("_trips"))), F.lit(0)).alias(f"invalid_{end}_zones")

    return pairs.agg(*[unknown(end) for end in ends]).select(F.lit("Zone Reference Validation").alias("metric"), "*")


def constraint_checks(
    df: DataFrame,
    ranges: dict[str, str] | None = None,
    not_null: tuple[str, ...] = (),
    unique: tuple[str, ...] = (),
    foreign: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Breaches per rule: range rules (name -> condition that must hold), not-null, unique and foreign keys.

    A null satisfies a range rule and a foreign key, as in a database.
    """
    broken = {f"range: {name}": ~F.expr(rule) for name, rule in (ranges or {}).items()}
    broken.update({f"not null: {name}": F.col(name).isNull() for name in not_null})
    rules = [*broken, *(f"unique: {name}" for name in unique), *(f"foreign key: {name}" for name in foreign or {})]
    place = {rule: i for i, rule in enumerate(rules)}

    # A row gives an entry to every rule it breaks, and its keys to the rules on keys; equal entries are counted where they are read.
    def entry(rule: str, counts: Column, key: Column) -> Column:
        return F.when(counts, F.struct(F.lit(place[rule]).alias("_rule"), key.cast("string").alias("_key")))

    entries = [entry(rule, breach, F.lit(None)) for rule, breach in broken.items()]
    entries += [entry(f"{kind}: {name}", F.col(name).isNotNull(), F.col(name)) for kind, names in (("unique", unique), ("foreign key", foreign or {})) for name in names]
    given = F.array_compact(F.array(*entries))
    counted = df.select(F.inline(given)).groupBy("_rule", "_key").agg(a.rows("_n"))

    known = None
    for name, (dim, key) in (foreign or {}).items():
        one = dim.select(F.lit(place[f"foreign key: {name}"]).alias("_rule"), F.col(key).cast("string").alias("_key")).distinct()
        known = one if known is None else known.unionByName(one)
    if known is not None:
        counted = counted.join(lookup(known.withColumn("_known", F.lit(True))), ["_rule", "_key"], "left")
    is_unique = F.col("_rule").isin([place[f"unique: {name}"] for name in unique]) if unique else F.lit(False)
    is_known = F.col("_known").isNotNull() if known is not None else F.lit(False)
    breaches = F.when(is_unique, (F.col("_n") > 1).cast("bigint")).when(is_known, F.lit(0)).otherwise(F.col("_n"))
    found = counted.groupBy("_rule").agg(F.sum(breaches).alias("breaches"))
    # One row per rule.
    listed = df.sparkSession.createDataFrame([(i, rule) for rule, i in place.items()], "_rule int, rule string")
    return listed.join(F.broadcast(found), "_rule", "left").select("rule", F.coalesce("breaches", F.lit(0)).cast("bigint").alias("breaches"))


def load_report(flagged: DataFrame) -> DataFrame:
    """What a loaded table holds: rows, valid share, time span, rows by type."""
    counts = flagged.agg(
        a.rows("total_trips"),
        a.count_where(F.col("is_valid_trip"), "valid_trips"),
        F.min("pickup_datetime").alias("min_date"),
        F.max("pickup_datetime").alias("max_date"),
        a.count_where(F.col("trip_type") == "yellow", "yellow_trips"),
        a.count_where(F.col("trip_type") == "green", "green_trips"),
    )
    return counts.withColumn("valid_pct", a.percent(F.col("valid_trips"), F.col("total_trips"), 1))


def available_months(trips: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(year, month) pairs from January of the first year with data up to the reference month."""
    last = F.max("pickup_date") if as_of is None else F.max(F.to_date(as_of))
    span = trips.agg(F.trunc(F.min("pickup_date"), "year").alias("_first"), F.trunc(last, "month").alias("_last"))
    months = F.sequence("_first", "_last", F.expr("INTERVAL 1 MONTH"))
    return span.select(F.explode(months).alias("_m")).select(
        F.year("_m").alias("data_year"), F.month("_m").alias("data_month")
    )
