"""Streaming queries run over the files of the driver tables until all of them are read.

Only windows that the watermark has closed are emitted, so their SQL asks for
the same: windows that end no later than the latest event minus the delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.operators import clean
from cabrank.registry.base import add
from cabrank.registry.trip_reports import DAILY, DAILY_FLOATS
from cabrank.sources import bindings, storage
from cabrank.streaming import live, upsert


def _stream(b, name: str) -> DataFrame:
    return b.spark.readStream.schema(bindings.TABLES[name]).parquet(f"{b.sf_dir}/{name}*.parquet")


def ride_stream(b) -> DataFrame:
    return bindings.view(b.spark, "rides", {"orders": _stream(b, "orders"), "supplier": b.table("supplier")})


def event_stream(b) -> DataFrame:
    events = _stream(b, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def trip_stream(b) -> DataFrame:
    sources = {n: b.table(n) for n in ("orders", "supplier", "customer")}
    raw = bindings.view(b.spark, "trips_raw", {"lineitem": _stream(b, "lineitem"), **sources})
    return clean.valid_trips(clean.curate(raw))


def emitted(b, stream: DataFrame) -> DataFrame:
    path = storage.scratch_path(b.spark, "stream")
    upsert.append_to_files(stream, f"{path}/out", f"{path}/checkpoint")
    return b.spark.read.parquet(f"{path}/out")


CLOSED = "(SELECT max(pickup_datetime) FROM {}) - INTERVAL 15 MINUTE"

add("stream_zone_demand", lambda b: emitted(b, live.stream_zone_demand(ride_stream(b))), f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, pickup_zone_id, count(*) AS trips_last_hour,
  count(*) FILTER (pickup_datetime >= window_start + INTERVAL 45 MINUTE) AS trips_last_15_min, avg(wait_time) AS avg_wait_time,
  count(DISTINCT driver_id) AS available_drivers
FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, pickup_datetime) - k * INTERVAL 15 MINUTE AS window_start
  FROM rides CROSS JOIN generate_series(0, 3) s(k))
WHERE window_start + INTERVAL 1 HOUR <= {CLOSED.format('rides')}
GROUP BY 1, 2, 3
""", "avg_wait_time")

add("stream_tumbling_hourly", lambda b: emitted(b, live.stream_tumbling_hourly(ride_stream(b))), f"""
SELECT date_trunc('hour', pickup_datetime) AS hour, pickup_zone_id, count(*) AS trip_count, avg(total_fare) AS avg_fare,
  avg(trip_distance) AS avg_distance
FROM completed WHERE date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR <= {CLOSED.format('completed')}
GROUP BY 1, 2
""", "avg_fare avg_distance")

# Every event arrives twice.
add("stream_dedup_late", lambda b: emitted(b, live.stream_dedup_late(
    event_stream(b).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"))), "SELECT * FROM events")

add("stream_sessions", lambda b: emitted(b, live.stream_sessions(ride_stream(b))), f"""
WITH g AS (
  SELECT *, CASE WHEN pickup_datetime < lag(pickup_datetime) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
  FROM rides WINDOW w AS (PARTITION BY driver_id ORDER BY pickup_datetime)),
s AS (SELECT *, sum(starts) OVER (PARTITION BY driver_id ORDER BY pickup_datetime) AS n FROM g)
SELECT driver_id, min(pickup_datetime) AS shift_start, max(pickup_datetime) + INTERVAL 30 MINUTE AS shift_end,
  count(*) AS rides, min(pickup_datetime) AS first_pickup, max(dropoff_datetime) AS last_dropoff,
  sum(total_fare) AS shift_revenue
FROM s GROUP BY driver_id, n HAVING max(pickup_datetime) + INTERVAL 30 MINUTE <= {CLOSED.format('rides')}
""", "shift_revenue")


def daily_upsert(b) -> DataFrame:
    path = storage.scratch_path(b.spark, "daily")
    upsert.stream_daily_upsert(trip_stream(b), path, f"{path}/checkpoint")
    return upsert.read_daily(b.spark, path)


def ride_changes(b) -> DataFrame:
    """Every ride in all the states it has gone through, the last one first, with the pickup time it has in the end."""
    final = F.col("trip_status")
    passed = F.when(final == "Requested", F.array(final)).when(final == "InProgress", F.array(final, F.lit("Requested")))
    states = passed.otherwise(F.array(final, F.lit("InProgress"), F.lit("Requested")))
    return ride_stream(b).withColumn("trip_status", F.explode(states))


def monitor(b) -> DataFrame:
    path = storage.scratch_path(b.spark, "monitor")
    upsert.stream_active_monitor(ride_changes(b), path, f"{path}/checkpoint")
    rows = upsert.read_monitor(b.spark, path)
    return rows.filter(F.col("version") == rows.agg(F.max("version")).scalar()).drop("version")


add("stream_active_monitor", monitor, """
WITH n AS (SELECT max(pickup_datetime) AS latest FROM rides)
SELECT count(*) FILTER (trip_status = 'InProgress') AS active_trips,
  count(DISTINCT driver_id) FILTER (trip_status = 'InProgress') AS active_drivers,
  count(*) FILTER (trip_status = 'Requested') AS pending_requests,
  avg((epoch(latest) - epoch(pickup_datetime)) / 60) FILTER (trip_status = 'InProgress') AS avg_trip_time_minutes
FROM rides CROSS JOIN n WHERE pickup_datetime >= latest - INTERVAL 4 HOUR
""", "avg_trip_time_minutes")

add("stream_daily_upsert", daily_upsert, DAILY, DAILY_FLOATS)
