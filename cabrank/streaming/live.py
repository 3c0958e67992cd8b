"""Live demand, monitoring and shifts as Structured Streaming queries.

Functions take and return streaming DataFrames, so the caller chooses the sink.
"Now" is the event time that has arrived, never the clock of the machine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.operators import aggregates as a


def stream_zone_demand(rides: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """Rides per zone in the last hour and in its last quarter, renewed every quarter of an hour.

    A stream cannot count distinct values, so rides are first put together per driver; the
    drivers of a window are then rows. Both steps follow the same watermark.
    """
    window = F.window("pickup_datetime", "1 hour", "15 minutes")
    in_last_quarter = F.col("pickup_datetime") >= F.col("window.end") - F.expr("INTERVAL 15 minutes")
    per_driver = (
        rides.withWatermark("pickup_datetime", delay)
        .withColumn("window", window)
        .groupBy("window", "pickup_zone_id", "driver_id")
        .agg(
            a.rows("_trips"),
            a.count_where(in_last_quarter, "_recent"),
            F.sum("wait_time").alias("_wait"),
            F.count("wait_time").alias("_waits"),
        )
    )
    return (
        per_driver.groupBy("window", "pickup_zone_id")
        .agg(
            F.sum("_trips").alias("trips_last_hour"),
            F.sum("_recent").alias("trips_last_15_min"),
            F.try_divide(F.sum("_wait"), F.sum("_waits")).alias("avg_wait_time"),
            F.count("driver_id").alias("available_drivers"),
        )
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "pickup_zone_id",
            "trips_last_hour", "trips_last_15_min", "avg_wait_time", "available_drivers",
        )
    )


def stream_tumbling_hourly(rides: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """Completed rides, mean fare and mean distance per hour and zone."""
    return (
        rides.filter(F.col("trip_status") == "Completed")
        .withWatermark("pickup_datetime", delay)
        .groupBy(F.window("pickup_datetime", "1 hour"), "pickup_zone_id")
        .agg(a.rows(), a.mean("total_fare", "avg_fare"), a.mean("trip_distance", "avg_distance"))
        .select(F.col("window.start").alias("hour"), "pickup_zone_id", "trip_count", "avg_fare", "avg_distance")
    )


def stream_dedup_late(events: DataFrame, key: str = "event_id", time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each event once: repeated ids are removed while the watermark covers them, and rows behind it are dropped."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def stream_sessions(rides: DataFrame, gap: str = "30 minutes", delay: str = "15 minutes") -> DataFrame:
    """Driver shifts: rides of a driver whose pickups follow each other within the gap."""
    return (
        rides.withWatermark("pickup_datetime", delay)
        .groupBy(F.session_window("pickup_datetime", gap).alias("shift"), "driver_id")
        .agg(
            a.rows("rides"),
            F.min("pickup_datetime").alias("first_pickup"),
            F.max("dropoff_datetime").alias("last_dropoff"),
            a.total("total_fare", "shift_revenue"),
        )
        .select(
            "driver_id", F.col("shift.start").alias("shift_start"), F.col("shift.end").alias("shift_end"),
            "rides", "first_pickup", "last_dropoff", "shift_revenue",
        )
    )
