"""Payments, fares, anomalies and management reports over valid trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cabrank.functions import columns as c
from cabrank.operators import aggregates as a, ordering, percentiles
from cabrank.operators.joins import cross_join_scalar, stats_join_by_key
from cabrank.plans.trip_demand import recent


# --- payments and fares -----------------------------------------------------


def payment_tips(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    grouped = percentiles.grouped(
        recent(trips, as_of, days),
        ["payment_type", "trip_type"],
        [
            a.rows(),
            a.total("total_amount", "total_revenue"),
            a.mean("fare_amount", "avg_fare"),
            a.mean("tip_amount", "avg_tip_amount"),
            a.mean("tip_percentage", "avg_tip_pct"),
        ],
        {"median_tip_pct": ("tip_percentage", 0.5), "p95_tip_pct": ("tip_percentage", 0.95)},
    )
    shared = a.share_of_total(grouped, "trip_count", "pct_of_type", ["trip_type"])
    return shared.withColumn("payment_method", c.payment_method()).drop("payment_type")


def fare_by_distance_band(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    banded = recent(trips, as_of, days).withColumn("distance_band", c.distance_band())
    grouped = percentiles.grouped(
        banded,
        ["distance_band", "trip_type"],
        [
            a.rows(),
            a.mean("trip_distance", "avg_distance"),
            a.mean("fare_amount", "avg_fare"),
            a.mean("fare_per_mile", "avg_fare_per_mile"),
            a.mean("total_amount", "avg_total"),
            a.mean("trip_duration_minutes", "avg_duration"),
            a.mean("trip_speed_mph", "avg_speed"),
        ],
        {"median_fare_per_mile": ("fare_per_mile", 0.5)},
    )
    return grouped.orderBy("trip_type", ordering.band_order())


def rate_code_analysis(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    grouped = recent(trips, as_of, days).groupBy("rate_code_id", "trip_type").agg(
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("total_amount", "avg_total"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("trip_duration_minutes", "avg_duration"),
    )
    return grouped.withColumn("rate_type", c.rate_type()).drop("rate_code_id")


def tip_by_period(trips: DataFrame) -> DataFrame:
    """Card tips by part of the day."""
    cards = trips.filter(F.col("payment_type") == 1).withColumn("time_period", c.day_part())
    return percentiles.grouped(
        cards,
        ["time_period", "trip_type"],
        [a.rows(), a.mean("tip_amount", "avg_tip_amount"), a.mean("tip_percentage", "avg_tip_pct")],
        {"median_tip_pct": ("tip_percentage", 0.5), "p95_tip_pct": ("tip_percentage", 0.95)},
    )


FARE_LEVELS = {
    "p10_fare": 0.1, "p25_fare": 0.25, "median_fare": 0.5, "p75_fare": 0.75,
    "p90_fare": 0.9, "p95_fare": 0.95, "p99_fare": 0.99,
}


def fare_percentiles(trips: DataFrame) -> DataFrame:
    grouped = percentiles.grouped(
        trips,
        ["trip_type"],
        [a.rows("total_trips"), a.mean("fare_amount", "mean_fare"), a.spread("fare_amount", "stddev_fare")],
        {name: ("fare_amount", p) for name, p in FARE_LEVELS.items()},
    )
    rounded = {name: c.rounded(name, 2) for name in [*FARE_LEVELS, "mean_fare", "stddev_fare"]}
    return grouped.withColumns(rounded)


# --- anomalies --------------------------------------------------------------


def fare_zscore_by_type(trips: DataFrame, as_of=None, days: int = 7, ddof: int = 1, key: str = "trip_key") -> DataFrame:
    """Trips whose fare per mile is more than two deviations from the mean of their type."""
    week = recent(trips, as_of, days)
    stats = week.filter(F.col("fare_per_mile") > 0).groupBy("trip_type").agg(
        a.mean("fare_per_mile", "avg_fare_per_mile"), a.spread("fare_per_mile", "stddev_fare_per_mile", ddof)
    )
    score = F.abs(c.z_score("fare_per_mile", "avg_fare_per_mile", "stddev_fare_per_mile"))
    scored = stats_join_by_key(week, stats).withColumn("fare_z_score", score).filter(F.col("fare_z_score") > 2)
    return scored.select(
        key, "pickup_datetime", "trip_type", "fare_amount", "trip_distance", "fare_per_mile", "total_amount",
        "avg_fare_per_mile", "stddev_fare_per_mile", "fare_z_score",
        F.when(F.col("fare_z_score") > 3, "Anomaly").otherwise("Outlier").alias("fare_classification"),
    )


def fare_anomaly_rules(trips: DataFrame, as_of=None, days: int = 7, k: int = 100, key: str = "trip_key") -> DataFrame:
    """Latest trips that break a fare or speed rule, with the first rule they break."""
    week = recent(trips, as_of, days)
    stats = week.filter(F.col("fare_per_mile") > 0).agg(
        a.mean("fare_per_mile", "_mile_mean"), a.spread("fare_per_mile", "_mile_sd"),
        a.mean("total_amount", "_total_mean"), a.spread("total_amount", "_total_sd"),
    )
    scored = cross_join_scalar(week, stats).withColumns(
        {
            "_mile_z": c.z_score("fare_per_mile", "_mile_mean", "_mile_sd"),
            "_total_z": c.z_score("total_amount", "_total_mean", "_total_sd"),
        }
    )
    too_fast = (F.col("trip_duration_minutes") < 2) & (F.col("trip_distance") > 1)
    rules = (
        F.when(F.abs("_mile_z") > 3, "High Fare Anomaly")
        .when(F.abs("_total_z") > 3, "High Total Anomaly")
        .when(too_fast, "Suspiciously Fast")
        .when(F.col("trip_speed_mph") > 80, "Unrealistic Speed")
    )
    broken = scored.withColumn("anomaly_type", rules).filter("anomaly_type IS NOT NULL")
    latest = ordering.top_k(broken, k, F.desc("pickup_datetime"), key, "total_amount")
    return latest.select(
        key, "pickup_datetime", "pickup_location_id", "dropoff_location_id", "trip_distance", "fare_amount",
        "total_amount", "fare_per_mile", "trip_duration_minutes", "payment_type",
        c.rounded("_mile_z", 2).alias("fare_per_mile_zscore"),
        c.rounded("_total_z", 2).alias("total_amount_zscore"),
        "anomaly_type",
    )


# --- management reports -----------------------------------------------------


def market_share(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    grouped = recent(trips, as_of, days).groupBy("trip_type").agg(
        a.rows(),
        a.total("total_amount", "total_revenue"),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("tip_percentage", "avg_tip_pct"),
    )
    shared = a.share_of_total(grouped, "trip_count", "trip_market_share_pct")
    return a.share_of_total(shared, "total_revenue", "revenue_market_share_pct")


def hourly_efficiency(trips: DataFrame, as_of=None, days: int = 30, ddof: int = 1) -> DataFrame:
    """Totals per hour, averaged by trip type."""
    return a.two_level(
        recent(trips, as_of, days),
        ["pickup_date", "pickup_hour", "trip_type"],
        [
            a.rows("_n"),
            a.total("total_amount", "_revenue"),
            a.mean("trip_duration_minutes", "_duration"),
            a.total("trip_duration_minutes", "_active"),
            a.spread("trip_duration_minutes", "_spread", ddof),
        ],
        ["trip_type"],
        [
            a.mean("_n", "avg_trips_per_hour"),
            a.mean("_revenue", "avg_revenue_per_hour"),
            a.mean("_duration", "avg_trip_duration"),
            a.mean("_active", "avg_active_minutes_per_hour"),
            a.mean("_spread", "avg_duration_variability"),
        ],
    )


def exec_dashboard(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """One row for the period. The window over days runs on one row per day of it."""
    daily = recent(trips, as_of, days).groupBy("pickup_date").agg(
        a.rows("_trips"),
        a.total("total_amount", "_revenue"),
        a.mean("fare_amount", "_fare"),
        a.distinct("pickup_location_id", "_zones"),
    )
    before = F.lag("_trips").over(Window.orderBy("pickup_date"))
    growth = daily.withColumn("_growth", c.ratio((F.col("_trips") - before) * 100.0, before))
    return growth.agg(
        a.total("_trips", "total_trips"),
        a.total("_revenue", "total_revenue"),
        a.mean("_fare", "avg_fare"),
        a.mean("_zones", "avg_zones_per_day"),
        F.max("_trips").alias("peak_day_trips"),
        F.min("_trips").alias("min_day_trips"),
        a.mean("_trips", "avg_daily_trips"),
        c.rounded(F.avg("_growth"), 2).alias("avg_daily_growth_pct"),
    ).select(F.lit(f"Last {days} Days Summary").alias("metric_group"), "*")


def exec_summary(trips: DataFrame) -> DataFrame:
    return trips.agg(
        a.rows("total_trips"),
        c.rounded(F.sum("total_amount"), 2).alias("total_revenue"),
        c.rounded(F.avg("fare_amount"), 2).alias("avg_fare"),
        c.rounded(F.avg("trip_distance"), 2).alias("avg_distance"),
        c.rounded(F.avg("tip_percentage"), 2).alias("avg_tip_pct"),
        a.distinct_places("pickup_location_id", "unique_pickup_zones"),
        a.distinct_places("dropoff_location_id", "unique_dropoff_zones"),
        c.rounded(F.avg("trip_speed_mph"), 2).alias("avg_speed_mph"),
    ).select(F.lit("Overall Performance").alias("metric_category"), "*")


def revenue_by_payment(trips: DataFrame) -> DataFrame:
    grouped = trips.groupBy(c.payment_method().alias("payment_method")).agg(
        a.total("total_amount", "_revenue"), a.mean("tip_percentage", "_tip")
    )
    return a.share_of_total(grouped, "_revenue", "revenue_share_pct").select(
        "payment_method",
        c.rounded("_revenue", 2).alias("total_revenue"),
        "revenue_share_pct",
        c.rounded("_tip", 2).alias("avg_tip_pct"),
    )


def benchmarks(trips: DataFrame) -> DataFrame:
    in_rush = F.col("pickup_hour").between(7, 9) | F.col("pickup_hour").between(17, 19)
    medians = {
        "median_speed_mph": ("trip_speed_mph", 0.5),
        "median_fare_per_mile": ("fare_per_mile", 0.5),
        "median_tip_pct": ("tip_percentage", 0.5),
        "median_duration_min": ("trip_duration_minutes", 0.5),
    }
    row = percentiles.grouped(
        trips,
        [],
        [
            a.distinct_days(F.when(in_rush, F.col("pickup_date")), "rush_hour_days"),
            a.distinct_days("pickup_date", "total_days"),
        ],
        medians,
    )
    return row.select(
        F.lit("Performance Benchmarks").alias("category"),
        *[c.rounded(name, 2).alias(name) for name in medians],
        "rush_hour_days", "total_days",
    )


def get_trip_summary(trips: DataFrame, start, end, trip_type: str | None = None) -> DataFrame:
    """Totals and means between two dates (both inclusive), optionally of one trip type."""
    dated = trips.filter(F.col("pickup_date").between(c.moment(start).cast("date"), c.moment(end).cast("date")))
    if trip_type is not None:
        dated = dated.filter(F.col("trip_type") == trip_type)
    return dated.agg(
        a.rows("total_trips"),
        a.total("total_amount", "total_revenue"),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("trip_duration_minutes", "avg_duration"),
        a.distinct("pickup_location_id", "unique_zones"),
    )
