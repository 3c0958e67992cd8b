"""Standardise, enrich, validate and label trip records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cabrank.functions import columns as c
from cabrank.sources import schemas


# --- ingest -----------------------------------------------------------------


def standardize_trips(raw: DataFrame, kind: str) -> DataFrame:
    """Give a raw yellow or green file our column names, defaults for absent columns, and its trip type."""
    names = schemas.RAW_COLUMNS[kind]
    known = {raw_name.lower(): name for raw_name, name in names.items()}
    kept = [F.col(f"`{n}`").alias(known.get(n.lower(), n)) for n in raw.columns]
    present = {known.get(n.lower(), n) for n in raw.columns}
    added = [default.alias(name) for name, default in _absent_defaults().items() if name not in present]
    return raw.select(*kept, *added, F.lit(kind).alias("trip_type"))


def _absent_defaults() -> dict[str, Column]:
    zero = F.lit(0.0)
    return {
        "passenger_count": F.lit(1),
        "trip_distance": zero,
        "fare_amount": zero,
        "total_amount": zero,
        **{name: zero for name in schemas.AMOUNTS},
        **{name: F.lit(1) for name in schemas.CODES},
        "store_and_fwd_flag": F.lit("N"),
    }


def normalize_zones(raw: DataFrame) -> DataFrame:
    """Zone lookup with our names; a missing borough or service zone is 'Unknown'."""
    return raw.withColumnsRenamed(schemas.ZONE_COLUMNS).fillna("Unknown", ["borough", "service_zone"])


def require_columns(df: DataFrame, names=schemas.REQUIRED) -> DataFrame:
    """The same frame, or an error that names the columns it lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def drop_null_times(df: DataFrame) -> DataFrame:
    return df.filter(F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull())


def fill_defaults(df: DataFrame, passengers: bool = False) -> DataFrame:
    """Null or absent amounts become 0, codes 1, the flag 'N' and the type 'yellow'.

    Passengers are filled only on request: they belong to the validity rule, so
    filling them before ``validity_flag`` would change which trips are valid.
    """
    defaults: dict[str, object] = {name: 0.0 for name in schemas.AMOUNTS}
    defaults.update({name: 1 for name in schemas.CODES})
    defaults.update(store_and_fwd_flag="N", trip_type="yellow")
    if passengers:
        defaults["passenger_count"] = 1
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(filled)


# --- validity ---------------------------------------------------------------


def _plausible_trip() -> Column:
    return (
        (F.col("pickup_datetime") < F.col("dropoff_datetime"))
        & (F.col("trip_distance") > 0)
        & (F.col("trip_distance") < 100)
        & (F.col("fare_amount") > 0)
        & (F.col("total_amount") > 0)
        & F.col("pickup_location_id").isNotNull()
        & F.col("dropoff_location_id").isNotNull()
    )


def _plausible_passengers() -> Column:
    return (F.col("passenger_count") > 0) & (F.col("passenger_count") <= 6)


def validity_flag(df: DataFrame) -> DataFrame:
    """Three-valued: a null input gives a null flag unless another rule already fails."""
    return df.withColumn("is_valid_trip", _plausible_trip() & _plausible_passengers())


def valid_trips(df: DataFrame) -> DataFrame:
    return df.filter("is_valid_trip")


def valid_trips_speed(enriched: DataFrame, low: float = 1, high: float = 80) -> DataFrame:
    """Variant without the passenger rule, but with a plausible speed."""
    return enriched.filter(_plausible_trip() & F.col("trip_speed_mph").between(low, high))


def valid_trips_loader(df: DataFrame) -> DataFrame:
    """Variant that counts an unknown passenger number as one and asks for positive location ids."""
    located = (F.col("pickup_location_id") > 0) & (F.col("dropoff_location_id") > 0)
    return df.fillna(1, ["passenger_count"]).filter(_plausible_trip() & located & _plausible_passengers())


# --- features ---------------------------------------------------------------


def enrich_trips(df: DataFrame) -> DataFrame:
    """Calendar fields, duration, speed, fare per mile and tip percentage."""
    pickup = F.col("pickup_datetime")
    seconds = c.seconds_between("pickup_datetime", "dropoff_datetime")
    miles = F.col("trip_distance")
    return df.withColumns(
        {
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": F.dayofweek(pickup),
            "pickup_month": F.month(pickup),
            "pickup_year": F.year(pickup),
            "pickup_date": F.to_date(pickup),
            "is_weekend": F.dayofweek(pickup).isin(1, 7),
            "trip_duration_minutes": seconds / F.lit(60.0),
            "trip_speed_mph": F.when(seconds > 0, miles * F.lit(3600.0) / seconds),
            "fare_per_mile": F.when(miles > 0, F.col("fare_amount") / miles),
            "tip_percentage": c.calculate_tip_percentage(),
        }
    )


def label_columns(enriched: DataFrame) -> DataFrame:
    return enriched.withColumns(
        {
            "time_period": c.day_part(),
            "day_name": c.day_name(),
            "payment_method": c.payment_method(),
            "distance_band": c.distance_band(),
            "rate_type": c.rate_type(),
        }
    )


def curate(raw: DataFrame) -> DataFrame:
    """From standardised trips to the curated table: enriched, flagged, defaults filled."""
    return fill_defaults(validity_flag(enrich_trips(drop_null_times(require_columns(raw)))))


def surrogate_key(df: DataFrame, natural_key: list[str], order: str = "pickup_datetime", salts: int = 64) -> DataFrame:
    """Consecutive ``trip_id`` in order of pickup time, numbered without a global sort.

    Rows are counted per (time, salt); running totals of these counts, first
    over days and then inside a day, give every cell its first number, and rows
    are numbered inside their cell. A single busy moment is spread over
    ``salts`` cells, so no task has to order more than a slice of it. Trips
    picked up at the same moment are numbered in no particular order, but the
    same way on every run.
    """
    cell = ["_day", order, "_salt"]
    keyed = df.withColumns(
        {
            "_day": F.to_date(order),
            "_tie": F.xxhash64(*natural_key),
            "_salt": F.pmod(F.xxhash64(*natural_key), F.lit(salts)),
        }
    )
    counts = keyed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    days = counts.groupBy("_day").agg(F.sum("_rows").alias("_day_rows"))
    # One row per calendar day: the only window without partitions, and a bounded one.
    day_start = days.select(
        F.col("_day").alias("_d"),
        (F.sum("_day_rows").over(Window.orderBy("_day")) - F.col("_day_rows")).alias("_before_day"),
    )
    within = Window.partitionBy("_day").orderBy(order, "_salt")
    starts = counts.join(day_start, F.col("_day").eqNullSafe(F.col("_d"))).select(
        F.col(order).alias("_o"),
        F.col("_salt").alias("_s"),
        (F.col("_before_day") + F.sum("_rows").over(within) - F.col("_rows")).alias("_before"),
    )
    in_cell = Window.partitionBy(order, "_salt").orderBy("_tie", *natural_key)
    return (
        keyed.withColumn("_place", F.row_number().over(in_cell))
        .join(starts, F.col(order).eqNullSafe(F.col("_o")) & (F.col("_salt") == F.col("_s")))
        .withColumn("trip_id", F.col("_before") + F.col("_place"))
        .select("trip_id", *df.columns)
    )


# --- ride service -----------------------------------------------------------


def active_drivers(drivers: DataFrame) -> DataFrame:
    return drivers.filter(F.col("status") == "Active")


def completed_rides(rides: DataFrame) -> DataFrame:
    return rides.filter(F.col("trip_status") == "Completed")


def since(df: DataFrame, as_of, days: int, date_column: str = "pickup_date") -> DataFrame:
    """Rows dated at most ``days`` before ``as_of`` (or later).

    With a literal reference time the year and month bounds are added as well,
    so a table partitioned by them is pruned.
    """
    start = c.days_before(as_of, days)
    rows = df.filter(F.col(date_column) >= start)
    if date_column == "pickup_date" and not isinstance(as_of, Column):
        if {"pickup_year", "pickup_month"} <= set(df.columns):
            year, month = F.col("pickup_year"), F.col("pickup_month")
            rows = rows.filter((year > F.year(start)) | ((year == F.year(start)) & (month >= F.month(start))))
    return rows


def since_moment(df: DataFrame, as_of, interval: str, column: str = "pickup_datetime") -> DataFrame:
    """Rows timed at most an interval such as '4 hours' before ``as_of`` (or later)."""
    return df.filter(F.col(column) >= c.moment(as_of) - F.expr(f"INTERVAL {interval}"))
