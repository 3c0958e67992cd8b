"""Driver performance, utilisation and churn.

Rides are reduced to one row per driver (or driver and day) before drivers are
joined, so a driver with very many rides costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import columns as c
from cabrank.operators import aggregates as a, ordering, percentiles
from cabrank.operators.clean import active_drivers, completed_rides, since
from cabrank.operators.joins import cross_join_scalar


def ride_metrics(rides: DataFrame) -> DataFrame:
    """One row per driver with completed rides."""
    return completed_rides(rides).groupBy("driver_id").agg(
        F.count("ride_id").alias("total_trips"),
        a.total("total_fare", "total_revenue"),
        a.mean("total_fare", "avg_fare"),
        a.total("trip_distance", "total_distance"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("trip_duration", "avg_duration"),
        a.mean("customer_rating", "avg_customer_rating"),
        a.total("tips", "total_tips"),
        a.mean("tips", "avg_tips"),
        a.mean("route_efficiency", "avg_route_efficiency"),
        a.mean("wait_time", "avg_wait_time"),
        F.max("pickup_datetime").alias("last_trip_date"),
    )


def top_drivers(drivers: DataFrame, rides: DataFrame, as_of, days: int = 30, k: int = 20) -> DataFrame:
    metrics = ride_metrics(since(rides, as_of, days, "pickup_datetime"))
    named = drivers.select("driver_id", c.full_name().alias("driver_name"), F.col("rating").alias("driver_rating"))
    top = ordering.top_k(metrics.join(named, "driver_id"), k, F.desc("total_revenue"), "driver_id")
    return top.select(
        "driver_name", "driver_rating", "total_trips",
        c.rounded("total_revenue", 2).alias("total_revenue"),
        c.rounded("avg_fare", 2).alias("avg_fare"),
        c.rounded("avg_distance", 2).alias("avg_distance_miles"),
        c.rounded("avg_customer_rating", 2).alias("avg_customer_rating"),
        c.rounded("total_tips", 2).alias("total_tips"),
        c.rounded("avg_tips", 2).alias("avg_tips"),
        c.rounded("avg_route_efficiency", 2).alias("route_efficiency"),
        c.rounded(c.ratio("total_revenue", "total_trips"), 2).alias("revenue_per_trip"),
    )


def driver_metrics(drivers: DataFrame, rides: DataFrame, period_days: int = 30) -> DataFrame:
    """All drivers with completed rides, with names and derived rates."""
    info = drivers.select("driver_id", "first_name", "last_name", "rating", "status")
    return ride_metrics(rides).join(info, "driver_id", "left").withColumns(
        {
            "revenue_per_mile": F.col("total_revenue") / c.clip("total_distance", lower=1.0),
            "trips_per_day": F.col("total_trips") / F.lit(float(period_days)),
            "driver_name": c.full_name(),
        }
    )


def driver_days(rides: DataFrame) -> DataFrame:
    """One row per driver and working day."""
    return completed_rides(rides).groupBy("driver_id", F.to_date("pickup_datetime").alias("work_date")).agg(
        F.min("pickup_datetime").alias("first_trip"),
        F.max("dropoff_datetime").alias("last_trip"),
        a.rows("trips_count"),
        a.total("trip_duration", "driving_seconds"),
        a.total("total_fare", "daily_earnings"),
    )


def driver_utilization(drivers: DataFrame, rides: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Working span, driving time and earnings per day; the rate is null for a span of zero."""
    shifts = since(driver_days(rides), as_of, days, "work_date").withColumn(
        "_span", c.seconds_between("first_trip", "last_trip")
    )
    per_driver = shifts.groupBy("driver_id").agg(
        a.rows("days_worked"),
        a.mean("trips_count", "avg_trips_per_day"),
        F.avg(F.col("_span") / F.lit(3600.0)).alias("avg_hours_per_day"),
        F.avg(F.col("driving_seconds") / F.lit(3600.0)).alias("avg_driving_hours"),
        a.mean("daily_earnings", "avg_daily_earnings"),
        a.total("daily_earnings", "total_earnings"),
        F.avg(c.ratio("driving_seconds", "_span")).alias("utilization_rate"),
    )
    return per_driver.join(drivers.select("driver_id", c.full_name().alias("driver_name")), "driver_id")


def driver_utilization_pct(rides: DataFrame) -> DataFrame:
    """Variant in percent, with a working span of at least 0.1 hours, over all days."""
    days = driver_days(rides).withColumns(
        {
            "_working": c.hours_between("first_trip", "last_trip"),
            "_driving": F.col("driving_seconds") / F.lit(3600.0),
        }
    )
    per_driver = days.groupBy("driver_id").agg(
        a.mean("trips_count", "daily_trips"),
        a.mean("daily_earnings", "daily_revenue"),
        a.mean("_working", "working_hours"),
        a.mean("_driving", "driving_hours"),
        F.avg(F.col("_driving") / c.clip("_working", lower=0.1) * 100).alias("utilization_rate"),
    )
    return per_driver.withColumn("trips_per_hour", F.col("daily_trips") / c.clip("working_hours", lower=1.0))


def utilization_summary(utilization: DataFrame) -> DataFrame:
    """From ``driver_utilization_pct``: means and the number of little used drivers."""
    rate = F.col("utilization_rate")
    return utilization.agg(
        a.rows("driver_count"),
        a.mean("working_hours", "avg_working_hours"),
        a.mean("driving_hours", "avg_driving_hours"),
        a.mean("utilization_rate", "avg_utilization_rate"),
        a.mean("trips_per_hour", "avg_trips_per_hour"),
        a.count_where(rate < 50, "drivers_below_50"),
        a.count_where(rate < 40, "drivers_below_40"),
        (50 - F.avg(rate)).alias("improvement_opportunity"),
    )


def driver_churn_sql(drivers: DataFrame, rides: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Active drivers with rides in the period, by whole days since their last ride (rides of any status)."""
    recent = since(rides, as_of, days, "pickup_datetime").groupBy("driver_id").agg(
        F.max("pickup_datetime").alias("_last"),
        F.count("ride_id").alias("trips_last_30_days"),
        a.mean("total_fare", "avg_fare_last_30_days"),
        a.mean("customer_rating", "avg_customer_rating"),
    )
    idle = c.whole_days_between("_last", c.moment(as_of))
    risk = F.when(idle > 14, "High Risk").when(idle > 7, "Medium Risk").otherwise("Low Risk")
    # Drivers without a ride would be dropped again by "at least one ride", so this is an inner join.
    return active_drivers(drivers).join(recent, "driver_id").select(
        "driver_id", c.full_name().alias("driver_name"), "status", "rating",
        idle.alias("days_since_last_trip"),
        "trips_last_30_days", "avg_fare_last_30_days", "avg_customer_rating", risk.alias("churn_risk"),
    )


def churn_levels(metrics: DataFrame, as_of) -> DataFrame:
    """Driver metrics with days since the last completed ride and one of five levels."""
    idle = c.whole_days_between("last_trip_date", c.moment(as_of))
    level = (
        F.when(idle.isNull(), "No Trips")
        .when(idle <= 7, "Active")
        .when(idle <= 14, "Low Risk")
        .when(idle <= 30, "Medium Risk")
        .otherwise("High Risk")
    )
    return metrics.withColumns({"days_since_last_trip": idle, "churn_risk": level})


def driver_churn_levels(levels: DataFrame) -> DataFrame:
    return a.value_counts(levels, "churn_risk", "driver_count")


AT_RISK = ("Medium Risk", "High Risk")


def churn_by_level_profile(levels: DataFrame, retained: float = 0.7) -> DataFrame:
    at_risk = F.col("churn_risk").isin(*AT_RISK)
    revenue = F.coalesce(F.sum(F.when(at_risk, F.col("total_revenue"))), F.lit(0.0))
    return levels.groupBy("churn_risk").agg(
        a.mean("avg_customer_rating", "avg_customer_rating"),
        a.mean("avg_fare", "avg_fare"),
        a.mean("total_trips", "avg_trips"),
        revenue.alias("at_risk_revenue"),
        (revenue * retained).alias("retained_value"),
    )


def at_risk_performers(levels: DataFrame, min_rating: float = 4.0) -> DataFrame:
    """Well rated drivers at risk whose revenue is above the median of all drivers."""
    median = percentiles.grouped(levels, [], [], {"_median": ("total_revenue", 0.5)})
    chosen = cross_join_scalar(levels, median).filter(
        F.col("churn_risk").isin(*AT_RISK)
        & (F.col("avg_customer_rating") > min_rating)
        & (F.col("total_revenue") > F.col("_median"))
    )
    return chosen.select(
        "driver_id", "driver_name", "total_trips", "total_revenue", "avg_customer_rating",
        "days_since_last_trip", "churn_risk",
    )


def weekly_performance(rides: DataFrame) -> DataFrame:
    """Totals per calendar week (from Monday); the rating is the mean of the drivers' weekly means."""
    week = F.to_date(F.date_trunc("week", "pickup_datetime")).alias("week_start")
    return a.two_level(
        completed_rides(rides),
        [week, F.col("driver_id")],
        [F.count("ride_id").alias("_n"), a.total("total_fare", "_revenue"), a.mean("customer_rating", "_rating")],
        ["week_start"],
        [a.total("_n", "weekly_trips"), a.total("_revenue", "weekly_revenue"), a.mean("_rating", "avg_customer_rating")],
    )


def low_rating_drivers(metrics: DataFrame, threshold: float = 4.0) -> DataFrame:
    return metrics.agg(
        a.rows("driver_count"),
        a.count_where(F.col("status") == "Active", "active_drivers"),
        a.count_where(F.col("avg_customer_rating") < threshold, "low_rating_drivers"),
        a.mean("total_trips", "avg_trips_per_driver"),
        a.mean("total_revenue", "avg_revenue_per_driver"),
        a.mean("avg_customer_rating", "avg_customer_rating"),
    )
