"""Cleaning steps, joins, aggregates, windows, orders, unions and scalar functions on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cabrank.functions import columns as c
from cabrank.functions.sql import register_functions
from cabrank.operators import aggregates as a, clean, joins, ml, ordering, percentiles, quality, setops, windows
from cabrank.plans import ride_drivers
from cabrank.registry.base import AS_OF, BAND, DAY, PART, PAYMENT, RATE, add, DERIVED_FLOATS
from cabrank.registry.storage_queries import raw_dialect

# --- cleaning ---------------------------------------------------------------


def standardized(b) -> DataFrame:
    frames = [clean.standardize_trips(raw_dialect(b.trips_raw, kind), kind) for kind in ("yellow", "green")]
    return setops.append_types(*frames)


ZERO_AMOUNTS = """CAST(0 AS DOUBLE) AS extra, CAST(0 AS DOUBLE) AS mta_tax, CAST(0 AS DOUBLE) AS improvement_surcharge,
  CAST(0 AS DOUBLE) AS congestion_surcharge, CAST(0 AS DOUBLE) AS airport_fee, CAST(0 AS DOUBLE) AS ehail_fee"""

add("standardize_trips", standardized, f"SELECT *, {ZERO_AMOUNTS} FROM trips_raw")


def zones_with_gaps(b) -> DataFrame:
    return b.zones.select(
        F.col("location_id").alias("LocationID"),
        F.nullif("borough", F.lit("ASIA")).alias("Borough"),
        F.col("zone").alias("Zone"),
        F.nullif("service_zone", F.lit("Airports")).alias("service_zone"),
    )


add("normalize_zones", lambda b: clean.normalize_zones(zones_with_gaps(b)), """
SELECT location_id, coalesce(nullif(borough, 'ASIA'), 'Unknown') AS borough, zone,
  coalesce(nullif(service_zone, 'Airports'), 'Unknown') AS service_zone FROM zones
""")

add("fill_defaults", lambda b: clean.fill_defaults(b.trips_raw.withColumns(
    {"payment_type": F.nullif("payment_type", F.lit(3)), "store_and_fwd_flag": F.nullif("store_and_fwd_flag", F.lit("Y")),
     "tip_amount": F.nullif("tip_amount", F.lit(0.0))}), passengers=True), f"""
SELECT * REPLACE (coalesce(nullif(payment_type, 3), 1) AS payment_type, 'N' AS store_and_fwd_flag,
  coalesce(passenger_count, 1) AS passenger_count), {ZERO_AMOUNTS}
FROM trips_raw
""")

add("require_columns", lambda b: clean.require_columns(b.trips_raw).groupBy("trip_type").agg(a.rows()),
    "SELECT trip_type, count(*) AS trip_count FROM trips_raw GROUP BY 1")

add("drop_null_times", lambda b: clean.drop_null_times(b.trips_raw.withColumn(
    "dropoff_datetime", F.nullif("dropoff_datetime", "pickup_datetime"))).select(
        "trip_key", "pickup_datetime", "dropoff_datetime"),
    "SELECT trip_key, pickup_datetime, dropoff_datetime FROM trips_raw WHERE dropoff_datetime <> pickup_datetime")

add("validity_flag", lambda b: clean.validity_flag(b.trips_raw).select("trip_key", "total_amount", "is_valid_trip"),
    "SELECT trip_key, total_amount, is_valid_trip FROM trips_all")

DERIVED = [
    "trip_key", "total_amount", "pickup_hour", "pickup_day_of_week", "pickup_month", "pickup_year", "pickup_date",
    "is_weekend", "trip_duration_minutes", "trip_speed_mph", "fare_per_mile", "tip_percentage",
]

add("enrich_trips", lambda b: clean.enrich_trips(b.trips_raw).select(*DERIVED),
    f"SELECT {', '.join(DERIVED)} FROM trips_all", DERIVED_FLOATS)

add("valid_trips", lambda b: b.trips.select(*DERIVED), f"SELECT {', '.join(DERIVED)} FROM trips", DERIVED_FLOATS)

PLAUSIBLE = """pickup_datetime < dropoff_datetime AND trip_distance > 0 AND trip_distance < 100 AND fare_amount > 0
  AND total_amount > 0"""

add("valid_trips_speed", lambda b: clean.valid_trips_speed(clean.enrich_trips(b.trips_raw)).select(*DERIVED),
    f"SELECT {', '.join(DERIVED)} FROM trips_all WHERE {PLAUSIBLE} AND trip_speed_mph BETWEEN 1 AND 80", DERIVED_FLOATS)

add("valid_trips_loader", lambda b: clean.valid_trips_loader(b.trips_raw), f"""
SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count) FROM trips_raw
WHERE {PLAUSIBLE} AND pickup_location_id > 0 AND dropoff_location_id > 0 AND coalesce(passenger_count, 1) BETWEEN 1 AND 6
""")

add("label_columns", lambda b: clean.label_columns(b.trips_all).select(
    "trip_key", "total_amount", "time_period", "day_name", "payment_method", "distance_band", "rate_type"), f"""
SELECT trip_key, total_amount, {PART} AS time_period, {DAY} AS day_name, {PAYMENT} AS payment_method,
  {BAND} AS distance_band, {RATE} AS rate_type FROM trips_all
""")

# Ids of equal times may come in any order, so each moment is compared by its first and last id.
add("surrogate_key", lambda b: clean.surrogate_key(b.trips, ["trip_key", "total_amount", "dropoff_datetime"])
    .groupBy("pickup_datetime").agg(
        F.min("trip_id").alias("first_id"), F.max("trip_id").alias("last_id"), F.countDistinct("trip_id").alias("ids")), """
SELECT pickup_datetime, min(n) AS first_id, max(n) AS last_id, count(*) AS ids
FROM (SELECT pickup_datetime, row_number() OVER (ORDER BY pickup_datetime) AS n FROM trips) GROUP BY 1
""")

add("active_drivers", lambda b: clean.active_drivers(b.drivers), "SELECT * FROM drivers WHERE status = 'Active'")

add("completed_rides", lambda b: b.completed, "SELECT * FROM completed")

add("predicates", lambda b: b.tz.filter(
    F.col("payment_type").isin(1, 2) & F.col("pickup_hour").between(7, 19) & ~F.col("is_weekend")
    & (F.col("pickup_zone").like("%Airport%") | F.col("dropoff_zone").ilike("%nation_1%"))
    & F.col("dropoff_zone").isNotNull()).select("trip_key", "total_amount", "pickup_zone", "dropoff_zone"), """
SELECT trip_key, total_amount, pickup_zone, dropoff_zone FROM tz
WHERE payment_type IN (1, 2) AND pickup_hour BETWEEN 7 AND 19 AND NOT is_weekend
  AND (pickup_zone LIKE '%Airport%' OR dropoff_zone ILIKE '%nation_1%') AND dropoff_zone IS NOT NULL
""")


def dated_counts(b) -> DataFrame:
    frames = [
        clean.since(b.recent(days), b.trips_as_of, days).agg(F.lit(f"{days} days").alias("period"), a.rows("row_count"))
        for days in (7, 30, 90)
    ]
    frames += [
        clean.since_moment(b.rides, "2024-01-20 12:00:00", span).agg(F.lit(span).alias("period"), a.rows("row_count"))
        for span in ("4 hours", "1 hour", "15 minutes")
    ]
    return setops.union_common(*frames)


add("relative_time_filter", dated_counts, """
SELECT '7 days' AS period, count(*) AS row_count FROM recent7 UNION ALL SELECT '30 days', count(*) FROM recent30
UNION ALL SELECT '90 days', count(*) FROM recent90
UNION ALL SELECT '4 hours', count(*) FROM rides WHERE pickup_datetime >= TIMESTAMP '2024-01-20 08:00:00'
UNION ALL SELECT '1 hour', count(*) FROM rides WHERE pickup_datetime >= TIMESTAMP '2024-01-20 11:00:00'
UNION ALL SELECT '15 minutes', count(*) FROM rides WHERE pickup_datetime >= TIMESTAMP '2024-01-20 11:45:00'
""")

# --- joins ------------------------------------------------------------------

ZONED = [
    "trip_key", "total_amount", "pickup_borough", "pickup_zone", "pickup_service_zone", "dropoff_borough",
    "dropoff_zone", "dropoff_service_zone",
]
add("trips_with_zones", lambda b: b.tz.select(*ZONED), f"SELECT {', '.join(ZONED)} FROM tz")

add("inner_equi", lambda b: joins.inner_equi(b.trips_all, b.zones.filter("borough <> 'ASIA'")).select(
    "trip_key", "total_amount", "pickup_zone", "dropoff_zone"), """
SELECT trip_key, total_amount, p.zone AS pickup_zone, d.zone AS dropoff_zone
FROM trips_all t JOIN zones p ON t.pickup_location_id = p.location_id JOIN zones d ON t.dropoff_location_id = d.location_id
WHERE p.borough <> 'ASIA' AND d.borough <> 'ASIA'
""")

add("left_outer", lambda b: joins.left_outer(
    b.drivers.select("driver_id", "first_name"), b.rides.select("driver_id", "ride_id", "total_fare", "trip_status"),
    "driver_id", F.col("trip_status") == "InProgress"), """
SELECT d.driver_id, first_name, ride_id, total_fare, trip_status
FROM drivers d LEFT JOIN rides r ON d.driver_id = r.driver_id AND trip_status = 'InProgress'
""")

add("left_then_filter", lambda b: joins.left_then_filter(
    b.drivers.select("driver_id", "first_name"), b.rides.select("driver_id", "ride_id", "total_fare", "trip_status"),
    "driver_id", F.col("trip_status") == "Completed"), """
SELECT d.driver_id, first_name, ride_id, total_fare, trip_status
FROM drivers d LEFT JOIN rides r ON d.driver_id = r.driver_id WHERE trip_status = 'Completed'
""")


def in_the_hour(b, how: str) -> DataFrame:
    """Rides with every weather report of their zone and hour, row by row."""
    reports = b.weather.select("weather_id", F.col("zone_id").alias("pickup_zone_id"), "datetime", "temperature")
    rides = b.rides.select("ride_id", "pickup_zone_id", "pickup_datetime", "total_fare")
    return joins.time_bucket_join(rides, reports, ["pickup_zone_id"], "pickup_datetime", "datetime", how).drop("datetime")


for _how in ("inner", "left"):
    add(f"time_bucket_join_{_how}", lambda b, how=_how: in_the_hour(b, how), f"""
SELECT ride_id, pickup_zone_id::BIGINT AS pickup_zone_id, pickup_datetime, total_fare, weather_id, temperature
FROM rides {_how.upper()} JOIN weather
  ON pickup_zone_id = zone_id AND date_trunc('hour', pickup_datetime) = date_trunc('hour', datetime)
""")


def matched_by_hour(b) -> DataFrame:
    """Rides and weather reports that share a zone and an hour, as counts per zone and hour."""
    rides = b.rides.groupBy("pickup_zone_id", joins.hour_bucket("pickup_datetime").alias("hour")).agg(a.rows("rides"))
    reports = b.weather.groupBy(F.col("zone_id").alias("pickup_zone_id"), joins.hour_bucket("datetime").alias("hour")).agg(
        a.rows("reports"), a.mean("temperature", "avg_temperature")
    )
    return rides.join(reports, ["pickup_zone_id", "hour"], "left")


add("multi_key_time_bucket", matched_by_hour, """
SELECT r.pickup_zone_id::BIGINT AS pickup_zone_id, r.hour, rides, reports, avg_temperature
FROM (SELECT pickup_zone_id, date_trunc('hour', pickup_datetime) AS hour, count(*) AS rides FROM rides GROUP BY 1, 2) r
LEFT JOIN (SELECT zone_id, date_trunc('hour', datetime) AS hour, count(*) AS reports, avg(temperature) AS avg_temperature
  FROM weather GROUP BY 1, 2) w ON r.pickup_zone_id = w.zone_id AND r.hour = w.hour
""", "avg_temperature")

add("or_theta_join", lambda b: joins.trips_at_locations(b.trips, b.zones.filter(c.is_airport("zone")).select(
    "location_id", "zone")).select("trip_key", "total_amount", "zone"), """
SELECT trip_key, total_amount, zone FROM trips t JOIN (SELECT * FROM zones WHERE zone LIKE '%Airport%') z
  ON t.pickup_location_id = z.location_id OR t.dropoff_location_id = z.location_id
""")

add("cross_join_scalar", lambda b: joins.cross_join_scalar(
    b.trips.select("trip_key", "total_amount"), b.trips.agg(a.mean("total_amount", "overall"))).select(
        "trip_key", "total_amount", (F.col("total_amount") - F.col("overall")).alias("difference")), """
SELECT trip_key, total_amount, total_amount - (SELECT avg(total_amount) FROM trips) AS difference FROM trips
""", "difference")

add("stats_join_by_key", lambda b: joins.stats_join_by_key(
    b.trips.select("trip_key", "trip_type", "total_amount"),
    b.trips.groupBy("trip_type").agg(a.mean("total_amount", "type_mean"))), """
SELECT trip_key, t.trip_type, total_amount, type_mean
FROM trips t JOIN (SELECT trip_type, avg(total_amount) AS type_mean FROM trips GROUP BY 1) s ON t.trip_type = s.trip_type
""", "type_mean")

add("anti_semi_check", lambda b: setops.append_types(
    joins.anti_semi_check(b.rides, "driver_id", clean.active_drivers(b.drivers), "driver_id")
    .select("ride_id", F.lit("orphan").alias("kind")),
    joins.matching_rows(b.rides, "driver_id", clean.active_drivers(b.drivers), "driver_id")
    .select("ride_id", F.lit("known").alias("kind"))), """
SELECT ride_id, CASE WHEN driver_id IN (SELECT driver_id FROM drivers WHERE status = 'Active') THEN 'known' ELSE 'orphan' END
  AS kind FROM rides
""")

add("map_lookup", lambda b: joins.map_lookup(
    b.drivers, b.completed.groupBy("driver_id").agg(F.max("pickup_datetime").alias("last_trip_date")),
    "driver_id", "last_trip_date").select("driver_id", "first_name", "last_trip_date"), """
SELECT d.driver_id, first_name, last_trip_date FROM drivers d
LEFT JOIN (SELECT driver_id, max(pickup_datetime) AS last_trip_date FROM completed GROUP BY 1) r ON d.driver_id = r.driver_id
""")

# --- aggregates -------------------------------------------------------------

add("group_agg", lambda b: a.group_agg(
    b.trips, ["pickup_year", "trip_type"], a.rows(), a.total("total_amount", "total_revenue"),
    a.mean("fare_amount", "avg_fare"), F.min("fare_amount").alias("min_fare"), F.max("fare_amount").alias("max_fare")), """
SELECT pickup_year, trip_type, count(*) AS trip_count, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,
  min(fare_amount) AS min_fare, max(fare_amount) AS max_fare FROM trips GROUP BY 1, 2
""", "total_revenue avg_fare")

add("group_by_alias_expr", lambda b: a.group_by_expr(b.trips, "time_period", c.day_part(), ["trip_type"], a.rows()),
    f"SELECT {PART} AS time_period, trip_type, count(*) AS trip_count FROM trips GROUP BY 1, 2")

add("global_agg", lambda b: b.trips.agg(a.rows(), a.total("total_amount", "total_revenue"), a.mean("fare_amount", "avg_fare")),
    "SELECT count(*) AS trip_count, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare FROM trips",
    "total_revenue avg_fare")

add("count_distinct", lambda b: b.trips.groupBy("trip_type").agg(
    a.distinct("pickup_location_id", "pickup_zones"), a.distinct("dropoff_location_id", "dropoff_zones"),
    a.distinct(F.when(F.col("is_weekend"), F.col("pickup_date")), "weekend_days")), """
SELECT trip_type, count(DISTINCT pickup_location_id) AS pickup_zones, count(DISTINCT dropoff_location_id) AS dropoff_zones,
  count(DISTINCT pickup_date) FILTER (is_weekend) AS weekend_days FROM trips GROUP BY 1
""")

add("conditional_agg", lambda b: b.trips_all.groupBy("pickup_year").agg(
    F.sum(F.when(F.col("trip_type") == "yellow", 1).otherwise(0)).alias("yellow_trips"),
    a.count_where(F.col("is_valid_trip"), "valid_trips"),
    F.avg(F.when(F.col("payment_type") == 1, F.col("tip_amount"))).alias("avg_card_tip")), """
SELECT pickup_year, count(*) FILTER (trip_type = 'yellow') AS yellow_trips, count(*) FILTER (is_valid_trip) AS valid_trips,
  avg(tip_amount) FILTER (payment_type = 1) AS avg_card_tip FROM trips_all GROUP BY 1
""", "avg_card_tip")

add("stddev", lambda b: b.trips.groupBy("trip_type").agg(
    a.spread("total_amount", "sample_spread"), a.spread("total_amount", "population_spread", ddof=0)), """
SELECT trip_type, stddev_samp(total_amount) AS sample_spread, stddev_pop(total_amount) AS population_spread
FROM trips GROUP BY 1
""", "sample_spread population_spread")

LEVELS = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
PERCENTILES = f"""
SELECT trip_type, {', '.join(f'quantile_cont(trip_speed_mph, {p}) AS {n}' for n, p in LEVELS.items())}
FROM trips GROUP BY 1
"""
add("percentile", lambda b: percentiles.grouped(
    b.trips, ["trip_type"], [], {n: ("trip_speed_mph", p) for n, p in LEVELS.items()}), PERCENTILES, " ".join(LEVELS))
add("percentile_ranges", lambda b: percentiles.grouped(
    b.trips, ["trip_type"], [], {n: ("trip_speed_mph", p) for n, p in LEVELS.items()}),
    PERCENTILES, " ".join(LEVELS))

add("having", lambda b: a.having(b.trips.groupBy("pickup_location_id").agg(a.rows()), 1800),
    "SELECT pickup_location_id, count(*) AS trip_count FROM trips GROUP BY 1 HAVING count(*) >= 1800")

add("two_level_agg", lambda b: a.two_level(
    b.trips, ["pickup_date", "trip_type"], [a.rows("n")], ["trip_type"], [a.mean("n", "avg_daily"), F.max("n").alias("most")]), """
SELECT trip_type, avg(n) AS avg_daily, max(n) AS most
FROM (SELECT pickup_date, trip_type, count(*) AS n FROM trips GROUP BY 1, 2) GROUP BY 1
""", "avg_daily")

add("agg_on_agg_window", lambda b: a.share_of_total(
    b.trips.groupBy("payment_type").agg(a.rows()), "trip_count", "pct_of_total", digits=None), """
SELECT payment_type, count(*) AS trip_count, (count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ())::DOUBLE AS pct_of_total
FROM trips GROUP BY 1
""", "pct_of_total")

add("pivot", lambda b: a.pivot(b.tz, "pickup_borough", "trip_type", ["yellow", "green"], F.count(F.lit(1)), 0), """
SELECT pickup_borough, count(*) FILTER (trip_type = 'yellow') AS yellow, count(*) FILTER (trip_type = 'green') AS green
FROM tz GROUP BY 1
""")

add("value_counts", lambda b: a.value_counts(b.rides, "trip_status"),
    "SELECT trip_status, count(*) AS row_count FROM rides GROUP BY 1")

add("first_last", lambda b: a.first_last(
    b.completed.withColumn("work_date", F.to_date("pickup_datetime")), ["driver_id", "work_date"],
    "pickup_datetime", "dropoff_datetime"), """
SELECT driver_id, CAST(pickup_datetime AS DATE) AS work_date, min(pickup_datetime) AS first_pickup_datetime,
  max(dropoff_datetime) AS last_dropoff_datetime FROM completed GROUP BY 1, 2
""")

add("distinct_zero_group", lambda b: b.trips.filter("total_amount < 0").agg(
    a.rows(), a.mean("fare_amount", "avg_fare"), a.distinct("pickup_location_id", "zones"),
    F.try_divide(F.count_if(F.col("is_weekend")) * 100.0, F.count(F.lit(1))).alias("weekend_pct")), """
SELECT count(*) AS trip_count, avg(fare_amount) AS avg_fare, count(DISTINCT pickup_location_id) AS zones,
  CAST(NULL AS DOUBLE) AS weekend_pct FROM trips WHERE total_amount < 0
""", "avg_fare")

# --- windows ----------------------------------------------------------------

add("lag_growth", lambda b: windows.lag_growth(
    b.trips.groupBy("pickup_year", "trip_type").agg(a.rows()), ["pickup_year"], "trip_count", "previous", "growth_pct",
    ["trip_type"]), """
SELECT *, round(((trip_count - previous) * CAST(100 AS DOUBLE) / previous)::DECIMAL(30,9), 2)::DOUBLE AS growth_pct
FROM (SELECT *, lag(trip_count) OVER (PARTITION BY trip_type ORDER BY pickup_year) AS previous
  FROM (SELECT pickup_year, trip_type, count(*) AS trip_count FROM trips GROUP BY 1, 2))
""")

add("share_of_total", lambda b: a.share_of_total(
    b.trips.groupBy("payment_type", "trip_type").agg(a.rows()), "trip_count", "pct_of_type", ["trip_type"]), """
SELECT payment_type, trip_type, count(*) AS trip_count,
  round((count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY trip_type))::DECIMAL(30,9), 2)::DOUBLE AS pct_of_type
FROM trips GROUP BY 1, 2
""")

add("row_number_rank", lambda b: windows.row_number_rank(
    b.tz.groupBy("pickup_zone").agg(a.rows(), F.max("fare_amount").alias("max_fare")),
    {"volume_rank": [F.desc("trip_count"), "pickup_zone"], "fare_rank": [F.desc("max_fare"), "pickup_zone"]}), """
SELECT *, CAST(row_number() OVER (ORDER BY trip_count DESC, pickup_zone) AS INT) AS volume_rank,
  CAST(row_number() OVER (ORDER BY max_fare DESC, pickup_zone) AS INT) AS fare_rank
FROM (SELECT pickup_zone, count(*) AS trip_count, max(fare_amount) AS max_fare FROM tz GROUP BY 1)
""")

add("moving_average", lambda b: windows.moving_average(
    b.trips.groupBy("pickup_date").agg(a.rows()), "pickup_date", "trip_count", {"ma_7": 7, "ma_14": 14}), """
SELECT *, avg(trip_count) OVER (ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_7,
  avg(trip_count) OVER (ORDER BY pickup_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS ma_14
FROM (SELECT pickup_date, count(*) AS trip_count FROM trips GROUP BY 1)
""", "ma_7 ma_14")

add("running_count", lambda b: windows.running_count(b.trips, "pickup_date", ["trip_type"]), """
SELECT trip_type, pickup_date, count(*) AS rows_now, any_value(running) AS running_trips
FROM (SELECT trip_type, pickup_date, count(*) OVER (PARTITION BY trip_type ORDER BY pickup_date) AS running FROM trips)
GROUP BY 1, 2
""")

add("last_n_vs_prev_n", lambda b: windows.last_n_vs_prev_n(
    b.trips.groupBy("pickup_date").agg(a.rows()), "pickup_date", "trip_count", 7), """
WITH n AS (SELECT pickup_date, count(*) AS k, row_number() OVER (ORDER BY pickup_date DESC) AS back FROM trips GROUP BY 1),
m AS (SELECT avg(k) FILTER (back <= 7) AS last_avg, avg(k) FILTER (back BETWEEN 8 AND 14) AS previous_avg FROM n)
SELECT *, (last_avg - previous_avg) / previous_avg * 100 AS trend_pct FROM m
""", "last_avg previous_avg trend_pct")

# --- orders -----------------------------------------------------------------

add("order_by", lambda b: b.trips.groupBy("pickup_year", "pickup_month").agg(a.rows()).orderBy(
    "pickup_year", F.desc("pickup_month")),
    "SELECT pickup_year, pickup_month, count(*) AS trip_count FROM trips GROUP BY 1, 2")

add("order_by_custom", lambda b: b.trips.groupBy(c.distance_band().alias("distance_band")).agg(a.rows()).withColumn(
    "place", ordering.band_order()).orderBy("place"), f"""
SELECT {BAND} AS distance_band, count(*) AS trip_count, CAST(CASE distance_band WHEN '0-1 miles' THEN 1 WHEN '1-2 miles' THEN 2
  WHEN '2-5 miles' THEN 3 WHEN '5-10 miles' THEN 4 WHEN '10-20 miles' THEN 5 ELSE 6 END AS INT) AS place
FROM trips GROUP BY 1
""")

add("top_k", lambda b: ordering.top_k(
    b.rides.select("ride_id", "total_fare"), 25, F.desc("total_fare"), "ride_id"),
    "SELECT ride_id, total_fare FROM rides ORDER BY total_fare DESC, ride_id LIMIT 25")

add("scalar_subquery_top1", lambda b: ordering.value_at_max(
    b.trips.groupBy("pickup_hour").agg(a.rows()), "pickup_hour", "trip_count", "peak_hour"),
    "SELECT pickup_hour AS peak_hour FROM trips GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1")

add("sort_for_layout", lambda b: ordering.sort_for_layout(b.trips.select("trip_key", "pickup_datetime", "total_amount")),
    "SELECT trip_key, pickup_datetime, total_amount FROM trips")

add("sample_rows", lambda b: ordering.sample_rows(b.trips.select("trip_key", "total_amount"), 1000, "trip_key"), """
SELECT trip_key, total_amount FROM trips ORDER BY md5(CAST(trip_key AS VARCHAR) || '|42'), trip_key, total_amount LIMIT 1000
""")

# --- unions -----------------------------------------------------------------


def by_type(b, kind: str, *drop: str) -> DataFrame:
    return b.trips.filter(F.col("trip_type") == kind).select(
        "trip_key", "trip_type", "total_amount", "tip_amount", "tolls_amount"
    ).drop(*drop)


add("union_common", lambda b: setops.union_common(by_type(b, "yellow", "tip_amount"), by_type(b, "green", "tolls_amount")),
    "SELECT trip_key, trip_type, total_amount FROM trips")

add("union_all_columns",
    lambda b: setops.union_all_columns(by_type(b, "yellow", "tip_amount"), by_type(b, "green", "tolls_amount")), """
SELECT trip_key, trip_type, total_amount, CASE WHEN trip_type = 'green' THEN tip_amount END AS tip_amount,
  CASE WHEN trip_type = 'yellow' THEN tolls_amount END AS tolls_amount FROM trips
""")

add("append_types", lambda b: setops.append_types(by_type(b, "yellow"), by_type(b, "green")),
    "SELECT trip_key, trip_type, total_amount, tip_amount, tolls_amount FROM trips")

# --- scalar functions -------------------------------------------------------

add("date_parts", lambda b: b.rides.select(
    "ride_id", F.hour("pickup_datetime").alias("hour_of_day"), F.dayofweek("pickup_datetime").alias("sunday_is_1"),
    F.weekday("pickup_datetime").alias("monday_is_0"), F.month("pickup_datetime").alias("month_no"),
    F.year("pickup_datetime").alias("year_no"), F.to_date("pickup_datetime").alias("pickup_date"),
    F.date_format("pickup_datetime", "EEEE").alias("day_name")), """
SELECT ride_id, CAST(hour(pickup_datetime) AS INT) AS hour_of_day, CAST(dayofweek(pickup_datetime) + 1 AS INT) AS sunday_is_1,
  CAST(isodow(pickup_datetime) - 1 AS INT) AS monday_is_0, CAST(month(pickup_datetime) AS INT) AS month_no,
  CAST(year(pickup_datetime) AS INT) AS year_no, CAST(pickup_datetime AS DATE) AS pickup_date,
  dayname(pickup_datetime) AS day_name FROM rides
""")

add("date_trunc", lambda b: b.rides.select(
    "ride_id", joins.hour_bucket("pickup_datetime").alias("pickup_hour"),
    F.to_date(F.date_trunc("week", "pickup_datetime")).alias("week_start")), """
SELECT ride_id, date_trunc('hour', pickup_datetime) AS pickup_hour,
  CAST(date_trunc('week', pickup_datetime) AS DATE) AS week_start FROM rides
""")

add("time_diff", lambda b: b.rides.select(
    "ride_id", c.seconds_between("pickup_datetime", "dropoff_datetime").alias("seconds"),
    c.minutes_between("pickup_datetime", "dropoff_datetime").alias("minutes"),
    c.hours_between("pickup_datetime", "dropoff_datetime").alias("hours"),
    c.whole_days_between("pickup_datetime", c.moment(b.rides_as_of)).alias("days_ago")), f"""
SELECT ride_id, CAST(epoch(dropoff_datetime) - epoch(pickup_datetime) AS BIGINT) AS seconds,
  (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60 AS minutes,
  (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600 AS hours,
  CAST(floor((epoch({AS_OF}) - epoch(pickup_datetime)) / 86400) AS INT) AS days_ago FROM rides
""", "minutes hours")

add("now_date_arith", lambda b: b.rides.select(
    "ride_id", c.days_before(b.rides_as_of, 30).alias("month_ago"),
    (F.col("pickup_datetime") >= c.moment(b.rides_as_of) - F.expr("INTERVAL 4 hours")).alias("is_live"),
    F.date_sub(F.to_date("pickup_datetime"), 7).alias("week_before")), f"""
SELECT ride_id, DATE '2024-01-01' AS month_ago, pickup_datetime >= {AS_OF} - INTERVAL 4 HOUR AS is_live,
  CAST(pickup_datetime AS DATE) - 7 AS week_before FROM rides
""")

add("math", lambda b: b.rides.select(
    "ride_id", c.rounded(c.ratio("total_fare", "trip_distance"), 2).alias("fare_per_mile"),
    F.abs(F.col("total_fare") - 250).alias("gap"), c.clip("trip_distance", 5.0, 20.0).alias("clipped"),
    F.col("total_fare").cast("bigint").alias("whole_fare"), F.nullif(F.col("ride_id") % 5, F.lit(0)).alias("remainder")), """
SELECT ride_id, round((total_fare / nullif(trip_distance, 0))::DECIMAL(30,9), 2)::DOUBLE AS fare_per_mile,
  abs(total_fare - 250) AS gap, least(greatest(trip_distance, 5), 20) AS clipped, trunc(total_fare)::BIGINT AS whole_fare,
  nullif(ride_id % 5, 0) AS remainder FROM rides
""", "gap")

add("null_handling", lambda b: b.trips_raw.select(
    "trip_key", "total_amount", F.coalesce("passenger_count", F.lit(1)).alias("passengers"),
    F.col("passenger_count").isNull().alias("unknown"), F.when(F.col("trip_distance") > 10, F.col("fare_amount")).alias("far_fare"))
    .dropna(subset=["far_fare"]), """
SELECT trip_key, total_amount, coalesce(passenger_count, 1) AS passengers, passenger_count IS NULL AS unknown,
  fare_amount AS far_fare FROM trips_raw WHERE trip_distance > 10 AND fare_amount IS NOT NULL
""")

add("string", lambda b: b.drivers.select(
    "driver_id", c.full_name().alias("driver_name"), c.short_label("first_name", 12).alias("short_name"),
    F.col("first_name").like("%0000%7").alias("ends_in_7"), F.col("first_name").ilike("SUPP%").alias("is_supplier")), """
SELECT driver_id, first_name || ' ' || last_name AS driver_name, left(first_name, 12) || '...' AS short_name,
  first_name LIKE '%0000%7' AS ends_in_7, first_name ILIKE 'SUPP%' AS is_supplier FROM drivers
""")

add("literal_columns", lambda b: b.trips.groupBy("trip_type").agg(a.rows()).select(F.lit("By type").alias("metric"), "*"),
    "SELECT 'By type' AS metric, trip_type, count(*) AS trip_count FROM trips GROUP BY trip_type")

add("surge_revenue_expr", lambda b: b.rides.select("ride_id", c.surge_revenue().alias("surge_part")), """
SELECT ride_id, CASE WHEN surge_multiplier > 1 THEN (total_fare - tips - tolls) * (surge_multiplier - 1) / surge_multiplier
  ELSE 0 END AS surge_part FROM rides
""", "surge_part")


# --- SQL functions of the session -------------------------------------------


def with_functions(b, df: DataFrame, *expressions: str) -> DataFrame:
    register_functions(b.spark, tables=False)
    return df.selectExpr(*expressions)


add("calculate_tip_percentage", lambda b: with_functions(
    b, b.trips_raw, "trip_key", "total_amount", "calculate_tip_percentage(tip_amount, fare_amount) AS tip_pct"), """
SELECT trip_key, total_amount, tip_percentage AS tip_pct FROM trips_all
""", "tip_pct")

add("calculate_speed", lambda b: with_functions(
    b, b.rides, "ride_id", "calculate_speed(trip_distance, trip_duration) AS speed_mph"), """
SELECT ride_id, trip_distance / (trip_duration / CAST(3600 AS DOUBLE)) AS speed_mph FROM rides
""", "speed_mph")

add("get_hour", lambda b: with_functions(b, b.rides, "ride_id", "get_hour(pickup_datetime) AS hour_of_day"),
    "SELECT ride_id, CAST(hour(pickup_datetime) AS INT) AS hour_of_day FROM rides")

add("get_day_of_week", lambda b: with_functions(b, b.rides, "ride_id", "get_day_of_week(pickup_datetime) AS monday_is_0"),
    "SELECT ride_id, CAST(isodow(pickup_datetime) - 1 AS INT) AS monday_is_0 FROM rides")

# --- statistics -------------------------------------------------------------


def metrics(b) -> DataFrame:
    return ride_drivers.driver_metrics(b.drivers, b.rides)


def segments_sql(k: int = 4, steps: int = ml.SEGMENT_STEPS) -> str:
    """The same search step by step: seeds s, distances, assignments and centres c of each step."""
    dims = range(len(ml.SEGMENT_FEATURES))
    between = lambda one, other: " + ".join(f"({one}f{i} - {other}f{i}) * ({one}f{i} - {other}f{i})" for i in dims)
    columns = ", ".join(f"f{i}" for i in dims)
    parts = [
        """m AS MATERIALIZED (
  SELECT driver_id, count(*) AS total_trips, avg(total_fare) AS avg_fare, avg(customer_rating) AS avg_customer_rating, avg(tips) AS avg_tips,
    avg(route_efficiency) AS avg_route_efficiency, sum(total_fare) AS total_revenue FROM completed GROUP BY 1)""",
        "z AS MATERIALIZED (SELECT driver_id, "
        + ", ".join(f"(CAST({n} AS DOUBLE) - (SELECT avg({n}) FROM m)) / (SELECT stddev_samp({n}) FROM m) AS f{i}" for i, n in enumerate(ml.SEGMENT_FEATURES))
        + " FROM m)",
        f"s0 AS MATERIALIZED (SELECT 0 AS cluster, {columns} FROM z ORDER BY {' + '.join(f'f{i} * f{i}' for i in dims)}, driver_id LIMIT 1)",
    ]
    for n in range(1, k):
        seeds = " UNION ALL ".join(f"SELECT {columns} FROM s{i}" for i in range(n))
        parts.append(
            f"s{n} AS MATERIALIZED (SELECT {n} AS cluster, {columns} FROM (SELECT z.*, (SELECT min({between('z.', 's.')}) FROM ({seeds}) s) AS far FROM z)"
            " ORDER BY far DESC, driver_id LIMIT 1)"
        )
    parts.append("c0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT cluster, {columns} FROM s{i}" for i in range(k)) + ")")
    for n in range(steps + 1):
        parts.append(
            f"a{n} AS MATERIALIZED (SELECT driver_id, min(struct_pack(far := {between('z.', 'c.')}, cluster := c.cluster)).cluster AS cluster"
            f" FROM z CROSS JOIN c{n} c GROUP BY driver_id)"
        )
        means = ", ".join(f"coalesce(avg(z.f{i}), any_value(c.f{i})) AS f{i}" for i in dims)
        parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c.cluster, {means} FROM c{n} c LEFT JOIN a{n} USING (cluster) LEFT JOIN z USING (driver_id) GROUP BY c.cluster)")
    return ",\n".join(parts) + f",\nfound AS (SELECT m.*, CAST(cluster AS INT) AS cluster FROM m JOIN a{steps} USING (driver_id))"


SEGMENT_FLOATS = "avg_fare avg_customer_rating avg_tips avg_route_efficiency total_revenue"
add("driver_segments", lambda b: ml.driver_segments(metrics(b)).select(
    "driver_id", "driver_name", *ml.SEGMENT_FEATURES, "total_revenue", "cluster"), f"""
WITH {segments_sql()}
SELECT driver_id, first_name || ' ' || last_name AS driver_name, {", ".join(ml.SEGMENT_FEATURES)}, total_revenue, cluster
FROM found LEFT JOIN (SELECT driver_id, first_name, last_name FROM drivers) USING (driver_id)
""", SEGMENT_FLOATS)


def profiled(b) -> DataFrame:
    return ml.segment_profile(ml.driver_segments(metrics(b)))


add("segment_profile", profiled, f"""
WITH {segments_sql()},
p AS (
  SELECT cluster, avg(total_trips) AS total_trips, avg(avg_fare) AS avg_fare, avg(avg_customer_rating) AS avg_customer_rating,
    avg(avg_tips) AS avg_tips, avg(avg_route_efficiency) AS avg_route_efficiency, avg(total_revenue) AS total_revenue,
    count(*) AS driver_count FROM found GROUP BY 1),
o AS (SELECT avg(total_trips) AS trips, avg(avg_customer_rating) AS rating, avg(avg_tips) AS tips, avg(total_revenue) AS revenue FROM p)
SELECT p.*, CASE WHEN avg_customer_rating > rating AND avg_tips > tips THEN 'Premium Service'
  WHEN total_trips > trips THEN 'High Volume Drivers' WHEN total_revenue < revenue THEN 'Underperformers'
  ELSE 'Standard Performers' END AS segment FROM p CROSS JOIN o
""", "total_trips " + SEGMENT_FLOATS)


def nearest_centres(b) -> DataFrame:
    rows = metrics(b)
    return ml.misplaced(rows, ml.segment_model(rows))


# The clusters themselves come from a seeded search; that every driver is with the nearest centre can be checked.
add("driver_segments_check", nearest_centres,
    "SELECT count(DISTINCT driver_id) AS row_count, CAST(0 AS BIGINT) AS misplaced FROM completed")

# The rule behind the labels, over clusters that SQL can repeat.
add("segment_profile_rule", lambda b: ml.segment_profile(metrics(b).withColumn("cluster", (F.col("driver_id") % 4).cast("int"))), """
WITH m AS (
  SELECT driver_id, CAST(driver_id % 4 AS INT) AS cluster, count(*) AS total_trips, avg(total_fare) AS avg_fare,
    avg(customer_rating) AS avg_customer_rating, avg(tips) AS avg_tips, avg(route_efficiency) AS avg_route_efficiency,
    sum(total_fare) AS total_revenue FROM completed GROUP BY 1),
p AS (
  SELECT cluster, avg(total_trips) AS total_trips, avg(avg_fare) AS avg_fare, avg(avg_customer_rating) AS avg_customer_rating,
    avg(avg_tips) AS avg_tips, avg(avg_route_efficiency) AS avg_route_efficiency, avg(total_revenue) AS total_revenue,
    count(*) AS driver_count FROM m GROUP BY 1),
o AS (SELECT avg(total_trips) AS trips, avg(avg_customer_rating) AS rating, avg(avg_tips) AS tips, avg(total_revenue) AS revenue FROM p)
SELECT p.*, CASE WHEN avg_customer_rating > rating AND avg_tips > tips THEN 'Premium Service'
  WHEN total_trips > trips THEN 'High Volume Drivers' WHEN total_revenue < revenue THEN 'Underperformers'
  ELSE 'Standard Performers' END AS segment FROM p CROSS JOIN o
""", "total_trips avg_fare avg_customer_rating avg_tips avg_route_efficiency total_revenue")

COVARIANCES = """
SELECT count(*) AS n, avg(pickup_hour) AS m1, avg(pickup_day_of_week) AS m2, avg(trip_distance) AS m3, avg(fare_amount) AS my,
  var_pop(pickup_hour) AS a, covar_pop(pickup_hour, pickup_day_of_week) AS b, covar_pop(pickup_hour, trip_distance) AS c,
  var_pop(pickup_day_of_week) AS d, covar_pop(pickup_day_of_week, trip_distance) AS e, var_pop(trip_distance) AS f,
  covar_pop(pickup_hour, fare_amount) AS y1, covar_pop(pickup_day_of_week, fare_amount) AS y2,
  covar_pop(trip_distance, fare_amount) AS y3, var_pop(fare_amount) AS yy FROM trips
"""
# The inverse of the symmetric matrix ((a, b, c), (b, d, e), (c, e, f)) by its cofactors.
add("fare_regression", lambda b: ml.fare_regression(b.trips), f"""
WITH s AS ({COVARIANCES}),
k AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM s),
w AS (SELECT *, ((d * f - e * e) * y1 + (c * e - b * f) * y2 + (b * e - c * d) * y3) / det AS w1,
    ((c * e - b * f) * y1 + (a * f - c * c) * y2 + (b * c - a * e) * y3) / det AS w2,
    ((b * e - c * d) * y1 + (b * c - a * e) * y2 + (a * d - b * b) * y3) / det AS w3 FROM k)
SELECT my - w1 * m1 - w2 * m2 - w3 * m3 AS intercept, w1 AS coef_pickup_hour, w2 AS coef_pickup_day_of_week,
  w3 AS coef_trip_distance, n AS rows_used, sqrt(yy - w1 * y1 - w2 * y2 - w3 * y3) AS rmse,
  (w1 * y1 + w2 * y2 + w3 * y3) / yy AS r2 FROM w
""", "intercept coef_pickup_hour coef_pickup_day_of_week coef_trip_distance rmse r2")

HISTOGRAMS = {
    "total_trips": 30, "total_revenue": 30, "avg_customer_rating": 20, "avg_tips": 30, "avg_route_efficiency": 30,
    "revenue_per_mile": 30,
}


def histogram_sql(name: str, bins: int) -> str:
    return f"""SELECT '{name}' AS measure, bin, any_value(lo) + bin * (any_value(hi) - any_value(lo)) / {bins} AS bin_start,
  any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / {bins} AS bin_end, count(*) AS row_count
FROM (SELECT CAST(least(floor(({name} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INT) AS bin, lo, hi
  FROM m CROSS JOIN (SELECT a - CASE WHEN a = b THEN 0.5 ELSE 0 END AS lo, b + CASE WHEN a = b THEN 0.5 ELSE 0 END AS hi
    FROM (SELECT min({name})::DOUBLE AS a, max({name})::DOUBLE AS b FROM m))) GROUP BY bin"""


MEASURED = """
WITH m AS (
  SELECT driver_id, count(*) AS total_trips, sum(total_fare) AS total_revenue, avg(customer_rating) AS avg_customer_rating,
    avg(tips) AS avg_tips, avg(route_efficiency) AS avg_route_efficiency,
    sum(total_fare) / greatest(sum(trip_distance), 1) AS revenue_per_mile
  FROM completed GROUP BY 1)
"""
add("histogram", lambda b: ml.histogram(metrics(b), HISTOGRAMS), MEASURED + "\nUNION ALL\n".join(histogram_sql(name, bins) for name, bins in HISTOGRAMS.items()), "bin_start bin_end")

# The medians that are drawn into the histograms.
add("histogram_medians", lambda b: percentiles.grouped(metrics(b), [], [], {f"median_{n}": (n, 0.5) for n in HISTOGRAMS}),
    MEASURED + "SELECT " + ", ".join(f"quantile_cont({n}::DOUBLE, 0.5) AS median_{n}" for n in HISTOGRAMS) + " FROM m",
    " ".join(f"median_{n}" for n in HISTOGRAMS))

# --- data quality -----------------------------------------------------------

CHECKED = ["pickup_datetime", "passenger_count", "trip_distance", "fare_amount"]

add("null_profile", lambda b: quality.null_profile(b.trips_raw, CHECKED), "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS column_name, count(*) - count({n}) AS null_count,
  round(((count(*) - count({n})) * 100.0 / count(*))::DECIMAL(30,9), 2)::DOUBLE AS null_pct FROM trips_raw""" for n in CHECKED))

add("dataset_overview", lambda b: quality.dataset_overview(b.trips), """
SELECT count(*) AS total_trips, min(pickup_datetime) AS earliest_trip, max(pickup_datetime) AS latest_trip,
  count(DISTINCT trip_type) AS trip_types, count(*) FILTER (trip_type = 'yellow') AS yellow_trips,
  count(*) FILTER (trip_type = 'green') AS green_trips, avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare,
  avg(total_amount) AS avg_total, avg(tip_amount) AS avg_tip, count(DISTINCT pickup_location_id) AS unique_pickup_zones,
  count(DISTINCT dropoff_location_id) AS unique_dropoff_zones FROM trips
""", "avg_distance avg_fare avg_total avg_tip")

add("retention_report", lambda b: quality.retention_report(b.trips_all), """
SELECT count(*) AS initial_rows, count(*) FILTER (is_valid_trip) AS kept_rows,
  round((count(*) FILTER (is_valid_trip) * 100.0 / count(*))::DECIMAL(30,9), 2)::DOUBLE AS retention_pct FROM trips_all
""")

add("ingestion_summary", lambda b: quality.ingestion_summary(b.trips_all), """
SELECT 'Data Ingestion Summary' AS metric, count(*) AS total_records, count(*) FILTER (trip_type = 'yellow') AS yellow_trips,
  count(*) FILTER (trip_type = 'green') AS green_trips, count(*) FILTER (is_valid_trip) AS valid_trips,
  count(*) FILTER (NOT is_valid_trip) AS invalid_trips,
  round((count(*) FILTER (is_valid_trip) * 100.0 / count(*))::DECIMAL(30,9), 2)::DOUBLE AS valid_percentage FROM trips_all
""")

add("date_coverage", lambda b: quality.date_coverage(b.trips_all), """
SELECT 'Date Range Coverage' AS metric, trip_type, min(pickup_date) AS earliest_date, max(pickup_date) AS latest_date,
  count(DISTINCT pickup_date) AS unique_dates FROM trips_all GROUP BY 2
""")

add("zone_reference_check", lambda b: quality.zone_reference_check(b.trips_all, b.zones.filter("borough <> 'ASIA'")), """
SELECT 'Zone Reference Validation' AS metric,
  count(*) FILTER (pickup_location_id NOT IN (SELECT location_id FROM zones WHERE borough <> 'ASIA')) AS invalid_pickup_zones,
  count(*) FILTER (dropoff_location_id NOT IN (SELECT location_id FROM zones WHERE borough <> 'ASIA')) AS invalid_dropoff_zones
FROM trips_all
""")

add("constraint_checks", lambda b: quality.constraint_checks(
    b.rides,
    ranges={"driver_rating": "driver_rating BETWEEN 1 AND 4", "surge_multiplier": "surge_multiplier >= 1"},
    not_null=("pickup_datetime",),
    unique=("ride_id", "customer_id"),
    foreign={"driver_id": (clean.active_drivers(b.drivers), "driver_id")}), """
SELECT 'range: driver_rating' AS rule, count(*) FILTER (driver_rating NOT BETWEEN 1 AND 4) AS breaches FROM rides
UNION ALL SELECT 'range: surge_multiplier', count(*) FILTER (surge_multiplier < 1) FROM rides
UNION ALL SELECT 'not null: pickup_datetime', count(*) - count(pickup_datetime) FROM rides
UNION ALL SELECT 'unique: ride_id', count(*) FROM (SELECT ride_id FROM rides GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique: customer_id', count(*) FROM (SELECT customer_id FROM rides GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'foreign key: driver_id', count(*) FROM rides
  WHERE driver_id NOT IN (SELECT driver_id FROM drivers WHERE status = 'Active')
""")

add("available_months", lambda b: quality.available_months(b.trips), """
SELECT CAST(year(m) AS INT) AS data_year, CAST(month(m) AS INT) AS data_month
FROM (SELECT unnest(generate_series(
  (SELECT date_trunc('year', min(pickup_date)) FROM trips)::TIMESTAMP,
  (SELECT date_trunc('month', max(pickup_date)) FROM trips)::TIMESTAMP, INTERVAL 1 MONTH)) AS m)
""")
