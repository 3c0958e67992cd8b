"""Zones, boroughs, airports and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import columns as c
from cabrank.operators import aggregates as a, ordering, percentiles, windows
from cabrank.operators.joins import add_zone, inner_equi, trips_at_locations
from cabrank.operators.sizing import lookup
from cabrank.plans.trip_demand import recent


def top_pickup_zones(trips: DataFrame, zones: DataFrame, as_of=None, days: int = 30, min_trips: int = 100, k: int = 25) -> DataFrame:
    """Busiest pickup zones with their share of all trips from a known zone; names meet one row per place and day."""
    cells = recent(trips, as_of, days).groupBy("pickup_location_id", "pickup_date").agg(
        a.rows("_n"),
        *a.partial_sums("fare_amount", "trip_distance", "total_amount", "tip_percentage", "trip_duration_minutes"),
    )
    grouped = add_zone(cells, zones, "pickup").groupBy("pickup_borough", "pickup_zone").agg(
        a.total("_n", "trip_count"),
        a.merged_mean("fare_amount", "avg_fare"),
        a.merged_mean("trip_distance", "avg_distance"),
        a.total("_sum_total_amount", "total_revenue"),
        a.merged_mean("tip_percentage", "avg_tip_pct"),
        a.merged_mean("trip_duration_minutes", "avg_duration_min"),
        a.distinct("pickup_date", "active_days"),
    )
    shared = a.share_of_total(grouped, "trip_count", "market_share_pct")
    return ordering.top_k(a.having(shared, min_trips), k, F.desc("trip_count"), "pickup_borough", "pickup_zone")


def borough_flows(trips: DataFrame, zones: DataFrame, as_of=None, days: int = 30, min_trips: int = 50) -> DataFrame:
    pairs = recent(trips, as_of, days).groupBy("pickup_location_id", "dropoff_location_id").agg(
        a.rows("_n"),
        *a.partial_sums("fare_amount", "trip_distance", "trip_duration_minutes", "total_amount", "tip_percentage"),
    )
    grouped = inner_equi(pairs, zones).groupBy("pickup_borough", "dropoff_borough").agg(
        a.total("_n", "trip_count"),
        a.merged_mean("fare_amount", "avg_fare"),
        a.merged_mean("trip_distance", "avg_distance"),
        a.merged_mean("trip_duration_minutes", "avg_duration"),
        a.total("_sum_total_amount", "total_revenue"),
        a.merged_mean("tip_percentage", "avg_tip_pct"),
    )
    return a.having(a.share_of_total(grouped, "trip_count", "flow_percentage"), min_trips)


def _airport_measures():
    return [
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("total_amount", "avg_total"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("trip_duration_minutes", "avg_duration"),
        a.mean("tip_percentage", "avg_tip_pct"),
    ]


def airport_by_airport(trips: DataFrame, zones: DataFrame, as_of=None, days: int = 30, any_case: bool = False) -> DataFrame:
    """Trips from and to each airport; a trip between two airports counts for both."""
    airports = zones.filter(c.is_airport("zone", any_case)).select(
        F.col("location_id").alias("airport_id"), F.col("zone").alias("airport_name"), "borough"
    )
    direction = F.when(F.col("airport_id") == F.col("pickup_location_id"), "From Airport").otherwise("To Airport")
    return (
        trips_at_locations(recent(trips, as_of, days), airports, "airport_id")
        .groupBy(direction.alias("trip_category"), "airport_name", "borough", "trip_type")
        .agg(*_airport_measures())
    )


def airport_categories(tz: DataFrame) -> DataFrame:
    """Every trip once; a pickup at an airport counts before a dropoff at one."""
    category = (
        F.when(c.is_airport("pickup_zone"), "From Airport")
        .when(c.is_airport("dropoff_zone"), "To Airport")
        .otherwise("Non-Airport")
    )
    return tz.groupBy(category.alias("trip_category"), "trip_type").agg(*_airport_measures())


def speed_by_borough_hour(
    trips: DataFrame, zones: DataFrame, as_of=None, days: int = 30, min_trips: int = 100
) -> DataFrame:
    moving = recent(trips, as_of, days).filter(F.col("trip_speed_mph").between(1, 60))
    grouped = percentiles.grouped(
        add_zone(moving, zones, "pickup"),
        ["pickup_hour", "pickup_borough", "trip_type"],
        [a.rows(), a.mean("trip_speed_mph", "avg_speed"), a.mean("trip_duration_minutes", "avg_duration")],
        {
            "q1_speed": ("trip_speed_mph", 0.25),
            "median_speed": ("trip_speed_mph", 0.5),
            "q3_speed": ("trip_speed_mph", 0.75),
        },
    )
    return a.having(grouped, min_trips)


def route_efficiency(trips: DataFrame, zones: DataFrame, as_of=None, days: int = 30, min_trips: int = 20, k: int = 50) -> DataFrame:
    """Busiest zone pairs. Trips are aggregated per pair of ids, names are joined to the result."""
    pairs = (
        recent(trips, as_of, days)
        .filter(F.col("trip_speed_mph").between(1, 60))
        .groupBy("pickup_location_id", "dropoff_location_id")
        .agg(
            a.rows(),
            a.mean("trip_distance", "_distance"),
            a.mean("trip_duration_minutes", "_duration"),
            a.mean("trip_speed_mph", "_speed"),
            a.mean("fare_per_mile", "_per_mile"),
            a.spread("trip_duration_minutes", "_spread"),
        )
    )
    named = inner_equi(a.having(pairs, min_trips), zones)
    top = ordering.top_k(named, k, F.desc("trip_count"), "pickup_location_id", "dropoff_location_id")
    return top.select(
        "pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough", "trip_count",
        c.rounded("_distance", 2).alias("avg_distance"),
        c.rounded("_duration", 1).alias("avg_duration_min"),
        c.rounded("_speed", 1).alias("avg_speed_mph"),
        c.rounded("_per_mile", 2).alias("avg_fare_per_mile"),
        c.rounded("_spread", 1).alias("duration_variability"),
    )


def zone_efficiency_ranks(tz: DataFrame, min_trips: int = 500, k: int = 20) -> DataFrame:
    """Zones ranked by speed, fare per mile and revenue. The ranking runs on one row per zone."""
    zones = a.having(
        tz.filter(F.col("pickup_zone").isNotNull() & F.col("trip_speed_mph").between(1, 60))
        .groupBy("pickup_zone", "pickup_borough")
        .agg(
            a.rows(),
            a.mean("trip_speed_mph", "_speed"),
            a.mean("fare_per_mile", "_per_mile"),
            a.mean("tip_percentage", "_tip"),
            a.total("total_amount", "_revenue"),
        ),
        min_trips,
    )
    tie = ["pickup_zone", "pickup_borough"]
    ranked = windows.row_number_rank(
        zones,
        {
            "speed_rank": [F.desc("_speed"), *tie],
            "fare_rank": [F.desc("_per_mile"), *tie],
            "revenue_rank": [F.desc("_revenue"), *tie],
        },
    )
    return ordering.top_k(ranked, k, "speed_rank").select(
        "pickup_zone", "pickup_borough", "trip_count",
        c.rounded("_speed", 2).alias("avg_speed_mph"),
        c.rounded("_per_mile", 2).alias("avg_fare_per_mile"),
        c.rounded("_tip", 2).alias("avg_tip_pct"),
        c.rounded("_revenue", 2).alias("total_revenue"),
        "speed_rank", "fare_rank", "revenue_rank",
    )


def revenue_by_borough(tz: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    known = recent(tz, as_of, days).filter(F.col("pickup_borough").isNotNull())
    return known.groupBy(F.col("pickup_borough").alias("borough"), "trip_type").agg(
        a.rows("total_trips"),
        a.total("total_amount", "total_revenue"),
        a.mean("total_amount", "avg_revenue_per_trip"),
        a.total("tip_amount", "total_tips"),
        a.mean("tip_percentage", "avg_tip_percentage"),
        a.distinct("pickup_date", "active_days"),
    )


def get_top_pickup_zones(trips: DataFrame, zones: DataFrame, n: int = 10, start=None, end=None) -> DataFrame:
    """The n busiest pickup zones, optionally between two dates (both inclusive)."""
    if start is not None:
        trips = trips.filter(F.col("pickup_date") >= c.moment(start).cast("date"))
    if end is not None:
        trips = trips.filter(F.col("pickup_date") <= c.moment(end).cast("date"))
    names = lookup(zones.select("location_id", F.col("zone").alias("zone_name"), "borough"))
    per_id = trips.groupBy("pickup_location_id").agg(a.rows("_n"), *a.partial_sums("fare_amount", "total_amount"))
    named = per_id.join(names, F.col("pickup_location_id") == F.col("location_id")).groupBy("zone_name", "borough")
    counted = named.agg(
        a.total("_n", "trip_count"), a.merged_mean("fare_amount", "avg_fare"), a.total("_sum_total_amount", "total_revenue")
    )
    return ordering.top_k(counted, n, F.desc("trip_count"), "zone_name", "borough")
