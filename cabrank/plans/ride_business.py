"""Routes, customers, revenue and anomalies of the ride service."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import columns as c
from cabrank.operators import aggregates as a, ordering, percentiles
from cabrank.operators.clean import completed_rides, since
from cabrank.operators.joins import cross_join_scalar
from cabrank.operators.sizing import lookup


# --- routes -----------------------------------------------------------------


def profitable_routes(rides: DataFrame, zones: DataFrame, min_trips: int = 50, k: int = 25) -> DataFrame:
    """Zone pairs with more than ``min_trips`` rides. Pairs of ids are merged by name before the limit."""
    per_mile = c.ratio("total_fare", "trip_distance")
    pairs = (
        completed_rides(rides)
        .withColumns({"_minutes": F.col("trip_duration") / F.lit(60.0), "_per_mile": per_mile})
        .groupBy("pickup_zone_id", "dropoff_zone_id")
        .agg(a.rows("_n"), *a.partial_sums("total_fare", "trip_distance", "_minutes", "_per_mile", "route_efficiency"))
    )
    for side in ("pickup", "dropoff"):
        names = lookup(zones.select(F.col("location_id").alias("_id"), F.col("zone").alias(f"{side}_zone")))
        pairs = pairs.join(names, F.col(f"{side}_zone_id") == F.col("_id")).drop("_id")
    routes = pairs.groupBy("pickup_zone", "dropoff_zone").agg(
        a.total("_n", "trip_count"),
        a.merged_mean("total_fare", "_fare"),
        a.merged_mean("trip_distance", "_distance"),
        a.merged_mean("_minutes", "_duration"),
        a.merged_mean("_per_mile", "_mile"),
        a.merged_mean("route_efficiency", "_efficiency"),
    )
    order = [F.desc("_fare"), F.desc("trip_count"), "pickup_zone", "dropoff_zone"]
    return ordering.top_k(routes.filter(F.col("trip_count") > min_trips), k, *order).select(
        "pickup_zone", "dropoff_zone", "trip_count",
        c.rounded("_fare", 2).alias("avg_fare"),
        c.rounded("_distance", 2).alias("avg_distance_miles"),
        c.rounded("_duration", 2).alias("avg_duration_min"),
        c.rounded("_mile", 2).alias("fare_per_mile"),
        c.rounded("_efficiency", 2).alias("route_efficiency"),
    )


def traffic_by_hour(rides: DataFrame) -> DataFrame:
    moving = completed_rides(rides).filter((F.col("trip_duration") > 0) & (F.col("trip_distance") > 0))
    speed = F.col("trip_distance") / (F.col("trip_duration") / F.lit(3600.0))
    return moving.groupBy(F.hour("pickup_datetime").alias("hour")).agg(
        F.avg(speed).alias("avg_speed_mph"),
        F.avg(F.col("trip_duration") / F.lit(60.0)).alias("avg_trip_duration_min"),
        a.mean("route_efficiency", "avg_route_efficiency"),
        a.rows("total_trips"),
    )


# --- customers --------------------------------------------------------------


def customer_ltv(riders: DataFrame, rides: DataFrame, as_of) -> DataFrame:
    """Customers with completed rides, summed up by customer type."""
    per_customer = completed_rides(rides).groupBy("customer_id").agg(
        F.count("ride_id").alias("_trips"),
        a.total("total_fare", "_value"),
        a.mean("total_fare", "_fare"),
        a.total("tips", "_tips"),
    )
    age = c.whole_days_between(F.col("registration_date").cast("timestamp"), c.moment(as_of))
    customers = riders.select("customer_id", "customer_type", age.alias("_age")).join(per_customer, "customer_id")
    customers = customers.withColumn("_monthly", c.ratio("_value", "_age") * 30)
    return percentiles.grouped(
        customers,
        ["customer_type"],
        [
            a.rows("customer_count"),
            a.mean("_trips", "avg_trips_per_customer"),
            a.mean("_value", "avg_lifetime_value"),
            a.mean("_fare", "avg_fare_per_trip"),
            a.mean("_tips", "avg_total_tips"),
            a.mean("_monthly", "avg_monthly_value"),
        ],
        {"median_lifetime_value": ("_value", 0.5)},
    )


def customer_churn(riders: DataFrame, rides: DataFrame, as_of, days: int = 90, idle_days: int = 30) -> DataFrame:
    """Churned and active customers by type.

    A customer without a ride in the period has no last date and counts as
    neither, but stays in the total.
    """
    recent = since(rides, as_of, days, "pickup_datetime").groupBy("customer_id").agg(
        F.max("pickup_datetime").alias("_last"),
        F.count("ride_id").alias("_trips"),
        a.total("total_fare", "_revenue"),
    )
    idle = c.whole_days_between("_last", c.moment(as_of))
    activity = riders.select("customer_id", "customer_type").join(recent, "customer_id", "left")
    counts = activity.groupBy("customer_type").agg(
        a.count_where(idle > idle_days, "churned_customers"),
        a.count_where(idle <= idle_days, "active_customers"),
        a.rows("total_customers"),
        F.avg(F.coalesce(F.col("_trips"), F.lit(0))).alias("avg_trips_per_customer"),
        a.mean("_revenue", "avg_revenue_per_customer"),
    )
    return counts.withColumn("churn_rate", a.percent(F.col("churned_customers"), F.col("total_customers")))


def ride_patterns(rides: DataFrame, riders: DataFrame) -> DataFrame:
    """Rides by customer type, hour and kind of day, reduced per customer before the join."""
    day_type = F.when(F.dayofweek("pickup_datetime").isin(1, 7), "Weekend").otherwise("Weekday")
    measures = ("total_fare", "trip_distance", "passenger_count")
    per_customer = completed_rides(rides).groupBy(
        "customer_id", F.hour("pickup_datetime").alias("hour"), day_type.alias("day_type")
    ).agg(a.rows("_n"), *a.partial_sums(*measures))
    typed = per_customer.join(riders.select("customer_id", "customer_type"), "customer_id")
    return typed.groupBy("customer_type", "hour", "day_type").agg(
        a.total("_n", "trip_count"),
        a.merged_mean("total_fare", "avg_fare"),
        a.merged_mean("trip_distance", "avg_distance"),
        a.merged_mean("passenger_count", "avg_passengers"),
    )


# --- revenue ----------------------------------------------------------------


def daily_revenue(rides: DataFrame, as_of, days: int = 30) -> DataFrame:
    recent = since(completed_rides(rides), as_of, days, "pickup_datetime")
    return recent.groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(
        a.rows("total_trips"),
        a.total("total_fare", "total_revenue"),
        a.total("base_fare", "base_revenue"),
        a.total("distance_fare", "distance_revenue"),
        a.total("time_fare", "time_revenue"),
        a.total("tips", "total_tips"),
        a.total("tolls", "total_tolls"),
        a.mean("surge_multiplier", "avg_surge"),
        F.sum(c.surge_revenue()).alias("surge_revenue"),
    )


def revenue_by_service(rides: DataFrame) -> DataFrame:
    grouped = completed_rides(rides).groupBy("service_type").agg(
        a.rows(),
        a.total("total_fare", "total_revenue"),
        a.mean("total_fare", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        F.avg(F.col("trip_duration") / F.lit(60.0)).alias("avg_duration_min"),
        a.total("tips", "total_tips"),
        a.mean("tips", "avg_tips"),
    )
    return a.share_of_total(grouped, "trip_count", "market_share_pct")


def zone_profitability(zones: DataFrame, rides: DataFrame) -> DataFrame:
    """Revenue per zone, driver and customer. Zones without completed rides do not appear."""
    sums = a.partial_sums("total_fare", "trip_distance", "wait_time")
    cells = a.id_cells(completed_rides(rides), ["pickup_zone_id"], ["driver_id", "customer_id"], F.count("ride_id").alias("_n"), *sums)
    per_zone = a.merged_ids(
        cells, ["pickup_zone_id"], {"unique_drivers": "driver_id", "unique_customers": "customer_id"},
        a.total("_n", "total_trips"),
        a.total("_sum_total_fare", "_revenue"),
        a.merged_mean("total_fare", "_fare"),
        a.merged_mean("trip_distance", "_distance"),
        a.merged_mean("wait_time", "_wait"),
    )
    named = per_zone.join(lookup(zones), F.col("pickup_zone_id") == F.col("location_id"))
    return named.select(
        F.col("zone").alias("zone_name"), "area_type", "total_trips",
        c.rounded("_revenue", 2).alias("total_revenue"),
        c.rounded("_fare", 2).alias("avg_fare"),
        c.rounded("_distance", 2).alias("avg_distance"),
        c.rounded(F.col("_wait") / 60.0, 2).alias("avg_wait_min"),
        "unique_drivers", "unique_customers",
        c.rounded(c.ratio("_revenue", "unique_drivers"), 2).alias("revenue_per_driver"),
        c.rounded(c.ratio("_revenue", "unique_customers"), 2).alias("revenue_per_customer"),
    )


# --- anomalies --------------------------------------------------------------


def ride_anomalies(rides: DataFrame, k: int = 100) -> DataFrame:
    """Latest completed rides that break a rule, with the first rule they break."""
    done = completed_rides(rides)
    stats = done.agg(
        a.mean("total_fare", "_fare_mean"), a.spread("total_fare", "_fare_sd"),
        a.mean("trip_distance", "_dist_mean"), a.spread("trip_distance", "_dist_sd"),
    )
    scored = cross_join_scalar(done, stats).withColumns(
        {
            "_fare_z": c.z_score("total_fare", "_fare_mean", "_fare_sd"),
            "_dist_z": c.z_score("trip_distance", "_dist_mean", "_dist_sd"),
        }
    )
    rules = (
        F.when(F.abs("_fare_z") > 3, "High Risk - Unusual Fare")
        .when(F.abs("_dist_z") > 3, "High Risk - Unusual Distance")
        .when((F.col("trip_distance") > 0) & (F.col("trip_duration") < 60), "High Risk - Impossibly Fast")
        .when(c.ratio("total_fare", "trip_distance") > 20, "Medium Risk - High Fare per Mile")
    )
    broken = scored.withColumn("anomaly_flag", rules).filter("anomaly_flag IS NOT NULL")
    return ordering.top_k(broken, k, F.desc("pickup_datetime"), "ride_id").select(
        "ride_id", "driver_id", "customer_id", "pickup_datetime", "total_fare", "trip_distance",
        (F.col("trip_duration") / F.lit(60.0)).alias("duration_minutes"),
        c.rounded("_fare_z", 2).alias("fare_zscore"),
        c.rounded("_dist_z", 2).alias("distance_zscore"),
        "anomaly_flag",
    )
