"""Demand, time and trend analyses over valid trips.

Every ``as_of`` is the reference date that replaces the clock; None means all trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import columns as c
from cabrank.operators import aggregates as a, ordering, percentiles, windows
from cabrank.operators.clean import since
from cabrank.operators.joins import cross_join_scalar


def recent(trips: DataFrame, as_of, days: int) -> DataFrame:
    return trips if as_of is None else since(trips, as_of, days)


def hourly_demand_by_dow(trips: DataFrame) -> DataFrame:
    grouped = percentiles.grouped(
        trips,
        ["pickup_hour", "pickup_day_of_week", "trip_type"],
        [
            a.rows(),
            a.mean("fare_amount", "avg_fare"),
            a.mean("trip_distance", "avg_distance"),
            a.mean("tip_percentage", "avg_tip_pct"),
        ],
        {"median_total": ("total_amount", 0.5)},
    )
    return grouped.withColumn("day_name", c.day_name()).drop("pickup_day_of_week")


def peak_hours_surge(trips: DataFrame, as_of=None, days: int = 30, ddof: int = 1) -> DataFrame:
    """Trips per hour and weekday against their mean over all such cells."""
    cells = recent(trips, as_of, days).groupBy("pickup_hour", "pickup_day_of_week").agg(
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("total_amount", "avg_total"),
        a.spread("total_amount", "stddev_total", ddof),
    )
    overall = cells.agg(a.mean("trip_count", "avg_hourly_trips"))
    trip_count, usual = F.col("trip_count"), F.col("avg_hourly_trips")
    level = (
        F.when(trip_count > usual * 1.5, "High Demand")
        .when(trip_count > usual * 1.2, "Moderate Demand")
        .otherwise("Normal Demand")
    )
    return cross_join_scalar(cells, overall).select(
        "pickup_hour", c.day_name().alias("day_name"), "trip_count", "avg_fare", "avg_total", "stddev_total",
        "avg_hourly_trips",
        c.ratio("trip_count", "avg_hourly_trips").alias("surge_multiplier"),
        ((c.ratio("trip_count", "avg_hourly_trips") - 1) * 100).alias("demand_vs_avg_pct"),
        level.alias("demand_level"),
    )


def rush_hour_periods(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    period = c.weekend_aware_day_part().alias("time_period")
    return recent(trips, as_of, days).groupBy(period, "trip_type").agg(*_period_measures())


def _period_measures():
    return [
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("trip_duration_minutes", "avg_duration"),
        a.mean("trip_speed_mph", "avg_speed"),
        a.mean("tip_percentage", "avg_tip_pct"),
    ]


def rush_hour_weekday_share(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    weekdays = recent(trips, as_of, days).filter(~F.col("is_weekend"))
    grouped = weekdays.groupBy(c.day_part().alias("time_period"), "trip_type").agg(*_period_measures())
    return a.share_of_total(grouped, "trip_count", "pct_of_total", ["trip_type"])


def rush_vs_non_rush(trips: DataFrame) -> DataFrame:
    grouped = trips.groupBy(c.rush_or_not().alias("period_type"), "trip_type").agg(*_period_measures())
    return a.share_of_total(grouped, "trip_count", "pct_of_total", ["trip_type"])


def monthly_trends(trips: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    return recent(trips, as_of, days).groupBy("pickup_year", "pickup_month", "trip_type").agg(
        a.rows("total_trips"),
        a.total("total_amount", "total_revenue"),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("tip_percentage", "avg_tip_pct"),
        a.mean("trip_speed_mph", "avg_speed"),
    )


def monthly_growth(trips: DataFrame) -> DataFrame:
    months = trips.groupBy("pickup_year", "pickup_month", "trip_type").agg(
        a.rows("total_trips"),
        a.total("total_amount", "total_revenue"),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("tip_percentage", "avg_tip_pct"),
        a.distinct("pickup_location_id", "unique_pickup_zones"),
    )
    return windows.lag_growth(
        months, ["pickup_year", "pickup_month"], "total_trips", "prev_month_trips",
        "month_over_month_growth_pct", ["trip_type"],
    )


def dow_patterns(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    grouped = recent(trips, as_of, days).groupBy("pickup_day_of_week", "is_weekend", "trip_type").agg(
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.total("total_amount", "total_revenue"),
        a.mean("tip_percentage", "avg_tip_pct"),
    )
    named = grouped.withColumn("day_name", c.day_name()).drop("pickup_day_of_week")
    return named.orderBy(ordering.monday_first(), "trip_type")


def daily_performance(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    return recent(trips, as_of, days).groupBy("pickup_date", "trip_type").agg(
        a.rows("total_trips"),
        a.total("total_amount", "total_revenue"),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("tip_percentage", "avg_tip_pct"),
        a.mean("trip_duration_minutes", "avg_duration"),
        a.mean("trip_speed_mph", "avg_speed"),
        a.distinct_places("pickup_location_id", "unique_pickup_zones"),
        a.distinct_places("dropoff_location_id", "unique_dropoff_zones"),
    )


def weekend_vs_weekday(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    period = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("period_type")
    return recent(trips, as_of, days).groupBy(period, "trip_type").agg(
        *_period_measures(), a.total("total_amount", "total_revenue")
    )


def demand_forecast_features(trips: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    cells = recent(trips, as_of, days).groupBy(
        "pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend", "trip_type"
    )
    features = cells.agg(a.rows(), a.total("total_amount", "total_revenue"), a.mean("fare_amount", "avg_fare"))
    return features.withColumn("day_name", c.day_name())


def peak_hours_top10(trips: DataFrame, k: int = 10) -> DataFrame:
    hours = trips.groupBy("pickup_hour").agg(
        a.count_where(F.col("trip_type") == "yellow", "yellow_trips"),
        a.count_where(F.col("trip_type") == "green", "green_trips"),
        a.rows("total_trips"),
        a.mean("fare_amount", "avg_fare"),
    )
    return ordering.top_k(hours, k, F.desc("total_trips"), "pickup_hour")


def peak_indicators(trips: DataFrame) -> DataFrame:
    """Busiest hour and weekday. Both come from one table of hour x weekday counts."""
    cells = trips.groupBy("pickup_hour", "pickup_day_of_week").agg(a.rows("_n"))
    hours = cells.groupBy("pickup_hour").agg(F.sum("_n").alias("peak_hour_trips"))
    days = cells.groupBy("pickup_day_of_week").agg(F.sum("_n").alias("peak_day_trips"))
    named = days.select(c.day_name().alias("peak_day"), "peak_day_trips")
    best_hour = ordering.top_k(hours, 1, F.desc("peak_hour_trips"), "pickup_hour")
    best_day = ordering.top_k(named, 1, F.desc("peak_day_trips"), "peak_day")
    return best_hour.crossJoin(F.broadcast(best_day)).select(
        F.lit("Peak Performance").alias("category"),
        F.col("pickup_hour").alias("peak_hour"), "peak_hour_trips", "peak_day", "peak_day_trips",
    )


def daily_7day_average(trips: DataFrame, n: int = 7) -> DataFrame:
    days = trips.groupBy("pickup_date", "trip_type").agg(a.rows("daily_trips"))
    return windows.moving_average(days, "pickup_date", "daily_trips", {"avg_7_day": n}, ["trip_type"])


def weekday_pivot(trips: DataFrame, types, measure: str | None = None) -> DataFrame:
    """Trips per weekday, or the sum of a measure, with one column per trip type."""
    cell = a.rows("_value") if measure is None else a.total(measure, "_value")
    cells = trips.groupBy("pickup_day_of_week", "trip_type").agg(cell)
    wide = a.pivot(cells, "pickup_day_of_week", "trip_type", list(types), F.sum("_value"), 0)
    return wide.withColumn("day_name", c.day_name()).drop("pickup_day_of_week")


def payment_pivot(trips: DataFrame, types) -> DataFrame:
    """Trips per payment method with one column per trip type."""
    cells = trips.groupBy(c.payment_method().alias("payment_method"), "trip_type").agg(a.rows())
    return a.pivot(cells, "payment_method", "trip_type", list(types), F.sum("trip_count"), 0)
