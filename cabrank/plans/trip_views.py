"""Views and summary tables over valid trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import columns as c
from cabrank.operators import aggregates as a
from cabrank.operators.joins import add_zone


def daily_trip_stats(trips: DataFrame) -> DataFrame:
    keys = ["pickup_date", "trip_type"]
    measures = ("total_amount", "trip_distance", "fare_amount", "tip_amount", "trip_duration_minutes", "tip_percentage")
    return a.place_cells(trips, keys, *measures).groupBy(*keys).agg(
        a.total("_n", "trip_count"),
        a.total("_sum_total_amount", "total_revenue"),
        a.merged_mean("trip_distance", "avg_distance"),
        a.merged_mean("fare_amount", "avg_fare"),
        a.merged_mean("tip_amount", "avg_tip"),
        a.merged_mean("trip_duration_minutes", "avg_duration_min"),
        a.merged_mean("tip_percentage", "avg_tip_pct"),
        a.distinct_places("pickup_location_id", "unique_pickup_zones"),
        a.distinct_places("dropoff_location_id", "unique_dropoff_zones"),
    )


def hourly_demand_view(trips: DataFrame) -> DataFrame:
    grouped = trips.groupBy("pickup_hour", "pickup_day_of_week", "is_weekend", "trip_type").agg(
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("tip_percentage", "avg_tip_pct"),
    )
    return grouped.withColumn("day_name", c.day_name())


def zone_popularity(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips are reduced to one row per place before the names are joined."""
    places = trips.groupBy("pickup_location_id").agg(
        a.rows("_n"), *a.partial_sums("fare_amount", "trip_distance", "tip_percentage")
    )
    return add_zone(places, zones, "pickup").groupBy("pickup_borough", "pickup_zone").agg(
        a.total("_n", "pickup_count"),
        a.merged_mean("fare_amount", "avg_fare"),
        a.merged_mean("trip_distance", "avg_distance"),
        a.merged_mean("tip_percentage", "avg_tip_pct"),
    )


def payment_analysis(trips: DataFrame) -> DataFrame:
    grouped = trips.groupBy("payment_type", "trip_type").agg(
        a.rows(),
        a.total("total_amount", "total_revenue"),
        a.mean("tip_amount", "avg_tip"),
        a.mean("tip_percentage", "avg_tip_pct"),
    )
    return grouped.withColumn("payment_method", c.payment_method())


def distance_distribution(trips: DataFrame) -> DataFrame:
    return (
        trips.filter(F.col("trip_distance") > 0)
        .groupBy(c.distance_band().alias("distance_range"), "trip_type")
        .agg(
            a.rows(),
            a.mean("fare_amount", "avg_fare"),
            a.mean("trip_duration_minutes", "avg_duration"),
            a.mean("trip_speed_mph", "avg_speed"),
        )
    )


def monthly_statistics(trips: DataFrame) -> DataFrame:
    keys = ["pickup_year", "pickup_month", "trip_type"]
    measures = ("total_amount", "fare_amount", "trip_distance", "tip_percentage", "trip_duration_minutes")
    return a.place_cells(trips, keys, *measures).groupBy(*keys).agg(
        a.total("_n", "total_trips"),
        a.total("_sum_total_amount", "total_revenue"),
        a.merged_mean("fare_amount", "avg_fare"),
        a.merged_mean("trip_distance", "avg_distance"),
        a.merged_mean("tip_percentage", "avg_tip_pct"),
        a.merged_mean("trip_duration_minutes", "avg_duration"),
        a.distinct_places("pickup_location_id", "unique_pickup_zones"),
        a.distinct_places("dropoff_location_id", "unique_dropoff_zones"),
    )


def daily_partials(trips: DataFrame) -> DataFrame:
    """Counts and sums per day, type, payment and pair of zones: all a day's summary needs, in mergeable form."""
    measures = ("total_amount", "trip_distance", "fare_amount", "tip_amount", "trip_duration_minutes")
    return a.place_cells(trips, ["pickup_date", "trip_type", "payment_type"], *measures)


def daily_from_partials(partials: DataFrame) -> DataFrame:
    """The columns of ``trip_summary_daily``, put together from partial results of any number of batches."""

    def trips_where(condition, name):
        return F.sum(F.when(condition, F.col("_n")).otherwise(0)).alias(name)

    return partials.groupBy(F.col("pickup_date").alias("summary_date")).agg(
        a.total("_n", "total_trips"),
        a.total("_sum_total_amount", "total_revenue"),
        a.merged_mean("trip_distance", "avg_trip_distance"),
        a.merged_mean("fare_amount", "avg_fare_amount"),
        a.merged_mean("tip_amount", "avg_tip_amount"),
        a.merged_mean("trip_duration_minutes", "avg_trip_duration"),
        a.distinct_places("pickup_location_id", "unique_pickup_zones"),
        a.distinct_places("dropoff_location_id", "unique_dropoff_zones"),
        trips_where(F.col("trip_type") == "yellow", "yellow_trips"),
        trips_where(F.col("trip_type") == "green", "green_trips"),
        trips_where(F.col("payment_type") == 2, "cash_trips"),
        trips_where(F.col("payment_type") == 1, "card_trips"),
    )


def trip_summary_daily(trips: DataFrame) -> DataFrame:
    return daily_from_partials(daily_partials(trips))


def trip_summary_hourly(tz: DataFrame) -> DataFrame:
    return tz.groupBy(
        F.col("pickup_date").alias("summary_date"),
        F.col("pickup_hour").alias("summary_hour"),
        "trip_type",
        "pickup_borough",
    ).agg(
        a.rows("total_trips"),
        a.total("total_amount", "total_revenue"),
        a.mean("trip_distance", "avg_trip_distance"),
        a.mean("fare_amount", "avg_fare_amount"),
        a.mean("tip_percentage", "avg_tip_percentage"),
        a.mean("trip_speed_mph", "avg_speed_mph"),
    )


def stamped(summary: DataFrame, as_of=None) -> DataFrame:
    """A summary with the time it was computed, as the stored tables keep it."""
    return summary.withColumn("updated_at", F.current_timestamp() if as_of is None else c.moment(as_of))


def hourly_demand_type(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_hour", "trip_type").agg(
        a.rows(),
        a.mean("fare_amount", "avg_fare"),
        a.mean("trip_distance", "avg_distance"),
        a.mean("tip_percentage", "avg_tip_pct"),
        a.mean("trip_speed_mph", "avg_speed"),
    )


def hourly_demand_borough(tz: DataFrame) -> DataFrame:
    return tz.groupBy("pickup_hour", "pickup_borough").agg(
        a.rows(), a.mean("fare_amount", "avg_fare"), a.mean("trip_speed_mph", "avg_speed")
    )
