"""Views, summary tables and named analyses over trip records."""

from __future__ import annotations

from cabrank.operators import joins
from cabrank.plans import trip_business as business
from cabrank.plans import trip_demand as demand
from cabrank.plans import trip_geography as geo
from cabrank.plans import trip_views as views
from cabrank.registry.base import BAND, DAY, PART, PAYMENT, PERIOD, PERIOD_FLOATS, RATE, add

# --- views and summary tables ----------------------------------------------

add("daily_trip_stats", lambda b: views.daily_trip_stats(b.trips), """
SELECT pickup_date, trip_type, count(*) AS trip_count, sum(total_amount) AS total_revenue,
  avg(trip_distance) AS avg_distance, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,
  avg(trip_duration_minutes) AS avg_duration_min, avg(tip_percentage) AS avg_tip_pct,
  count(DISTINCT pickup_location_id) AS unique_pickup_zones, count(DISTINCT dropoff_location_id) AS unique_dropoff_zones
FROM trips GROUP BY 1, 2
""", "total_revenue avg_distance avg_fare avg_tip avg_duration_min avg_tip_pct")

add("hourly_demand_view", lambda b: views.hourly_demand_view(b.trips), f"""
SELECT pickup_hour, pickup_day_of_week, {DAY} AS day_name, is_weekend, trip_type, count(*) AS trip_count,
  avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct
FROM trips GROUP BY ALL
""", "avg_fare avg_distance avg_tip_pct")

add("zone_popularity", lambda b: views.zone_popularity(b.trips, b.zones), """
SELECT z.borough AS pickup_borough, z.zone AS pickup_zone, count(*) AS pickup_count, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct
FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id GROUP BY 1, 2
""", "avg_fare avg_distance avg_tip_pct")

add("payment_analysis", lambda b: views.payment_analysis(b.trips), f"""
SELECT payment_type, {PAYMENT} AS payment_method, trip_type, count(*) AS trip_count,
  sum(total_amount) AS total_revenue, avg(tip_amount) AS avg_tip, avg(tip_percentage) AS avg_tip_pct
FROM trips GROUP BY payment_type, trip_type
""", "total_revenue avg_tip avg_tip_pct")

add("distance_distribution", lambda b: views.distance_distribution(b.trips), f"""
SELECT {BAND} AS distance_range, trip_type, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(trip_duration_minutes) AS avg_duration, avg(trip_speed_mph) AS avg_speed
FROM trips WHERE trip_distance > 0 GROUP BY 1, 2
""", "avg_fare avg_duration avg_speed")

MONTHLY = """
SELECT pickup_year, pickup_month, trip_type, count(*) AS total_trips, sum(total_amount) AS total_revenue,
  avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct,
  avg(trip_duration_minutes) AS avg_duration, count(DISTINCT pickup_location_id) AS unique_pickup_zones,
  count(DISTINCT dropoff_location_id) AS unique_dropoff_zones
FROM trips GROUP BY 1, 2, 3
"""
MONTHLY_FLOATS = "total_revenue avg_fare avg_distance avg_tip_pct avg_duration"
add("monthly_statistics", lambda b: views.monthly_statistics(b.trips), MONTHLY, MONTHLY_FLOATS)

DAILY = """
SELECT pickup_date AS summary_date, count(*) AS total_trips, sum(total_amount) AS total_revenue,
  avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount, avg(tip_amount) AS avg_tip_amount,
  avg(trip_duration_minutes) AS avg_trip_duration, count(DISTINCT pickup_location_id) AS unique_pickup_zones,
  count(DISTINCT dropoff_location_id) AS unique_dropoff_zones,
  count(*) FILTER (trip_type = 'yellow') AS yellow_trips, count(*) FILTER (trip_type = 'green') AS green_trips,
  count(*) FILTER (payment_type = 2) AS cash_trips, count(*) FILTER (payment_type = 1) AS card_trips
FROM trips GROUP BY 1
"""
DAILY_FLOATS = "total_revenue avg_trip_distance avg_fare_amount avg_tip_amount avg_trip_duration"
add("trip_summary_daily", lambda b: views.trip_summary_daily(b.trips), DAILY, DAILY_FLOATS)

add("trip_summary_hourly", lambda b: views.trip_summary_hourly(b.tz), """
SELECT pickup_date AS summary_date, pickup_hour AS summary_hour, trip_type, pickup_borough, count(*) AS total_trips,
  sum(total_amount) AS total_revenue, avg(trip_distance) AS avg_trip_distance, avg(fare_amount) AS avg_fare_amount,
  avg(tip_percentage) AS avg_tip_percentage, avg(trip_speed_mph) AS avg_speed_mph
FROM tz GROUP BY 1, 2, 3, 4
""", "total_revenue avg_trip_distance avg_fare_amount avg_tip_percentage avg_speed_mph")

# --- demand and time --------------------------------------------------------

add("hourly_demand_by_dow", lambda b: demand.hourly_demand_by_dow(b.trips), f"""
SELECT pickup_hour, {DAY} AS day_name, trip_type, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct,
  quantile_cont(total_amount, 0.5) AS median_total
FROM trips GROUP BY pickup_hour, pickup_day_of_week, trip_type
""", "avg_fare avg_distance avg_tip_pct median_total")

add("peak_hours_surge", lambda b: demand.peak_hours_surge(b.recent(30), b.trips_as_of), f"""
WITH cells AS (
  SELECT pickup_hour, pickup_day_of_week, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
    avg(total_amount) AS avg_total, stddev_samp(total_amount) AS stddev_total
  FROM recent30 GROUP BY 1, 2),
overall AS (SELECT avg(trip_count) AS avg_hourly_trips FROM cells)
SELECT pickup_hour, {DAY} AS day_name, trip_count, avg_fare, avg_total, stddev_total, avg_hourly_trips,
  trip_count / avg_hourly_trips AS surge_multiplier,
  (trip_count / avg_hourly_trips - 1) * 100 AS demand_vs_avg_pct,
  CASE WHEN trip_count > avg_hourly_trips * CAST(1.5 AS DOUBLE) THEN 'High Demand'
    WHEN trip_count > avg_hourly_trips * CAST(1.2 AS DOUBLE) THEN 'Moderate Demand' ELSE 'Normal Demand' END AS demand_level
FROM cells CROSS JOIN overall
""", "avg_fare avg_total stddev_total avg_hourly_trips demand_vs_avg_pct")

add("rush_hour_periods", lambda b: demand.rush_hour_periods(b.recent(30), b.trips_as_of), f"""
SELECT CASE WHEN pickup_hour BETWEEN 7 AND 9 AND NOT is_weekend THEN 'Morning Rush'
    WHEN pickup_hour BETWEEN 17 AND 19 AND NOT is_weekend THEN 'Evening Rush'
    WHEN pickup_hour BETWEEN 10 AND 16 AND NOT is_weekend THEN 'Daytime'
    WHEN pickup_hour BETWEEN 20 AND 23 THEN 'Evening' WHEN is_weekend THEN 'Weekend'
    ELSE 'Late Night/Early Morning' END AS time_period,
  trip_type, count(*) AS trip_count, {PERIOD}
FROM recent30 GROUP BY 1, 2
""", PERIOD_FLOATS)

add("rush_hour_weekday_share", lambda b: demand.rush_hour_weekday_share(b.recent(30), b.trips_as_of), f"""
SELECT {PART} AS time_period, trip_type, count(*) AS trip_count, {PERIOD},
  round((count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY trip_type))::DECIMAL(30,9), 2)::DOUBLE AS pct_of_total
FROM recent30 WHERE NOT is_weekend GROUP BY 1, 2
""", PERIOD_FLOATS)

add("rush_vs_non_rush", lambda b: demand.rush_vs_non_rush(b.trips), f"""
SELECT CASE WHEN pickup_hour IN (7, 8, 9, 17, 18, 19) AND NOT is_weekend THEN 'Rush Hour' ELSE 'Non-Rush Hour' END
    AS period_type,
  trip_type, count(*) AS trip_count, {PERIOD},
  round((count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY trip_type))::DECIMAL(30,9), 2)::DOUBLE AS pct_of_total
FROM trips GROUP BY 1, 2
""", PERIOD_FLOATS)

add("monthly_trends", lambda b: demand.monthly_trends(b.recent(90), b.trips_as_of), """
SELECT pickup_year, pickup_month, trip_type, count(*) AS total_trips, sum(total_amount) AS total_revenue,
  avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct,
  avg(trip_speed_mph) AS avg_speed
FROM recent90 GROUP BY 1, 2, 3
""", "total_revenue avg_fare avg_distance avg_tip_pct avg_speed")

add("monthly_growth", lambda b: demand.monthly_growth(b.trips), """
WITH months AS (
  SELECT pickup_year, pickup_month, trip_type, count(*) AS total_trips, sum(total_amount) AS total_revenue,
    avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct,
    count(DISTINCT pickup_location_id) AS unique_pickup_zones
  FROM trips GROUP BY 1, 2, 3),
lagged AS (
  SELECT *, lag(total_trips) OVER (PARTITION BY trip_type ORDER BY pickup_year, pickup_month) AS prev_month_trips
  FROM months)
SELECT *, round(((total_trips - prev_month_trips) * CAST(100 AS DOUBLE) / nullif(prev_month_trips, 0))::DECIMAL(30,9), 2)::DOUBLE
  AS month_over_month_growth_pct
FROM lagged
""", "total_revenue avg_fare avg_distance avg_tip_pct")

add("dow_patterns", lambda b: demand.dow_patterns(b.recent(30), b.trips_as_of), f"""
SELECT {DAY} AS day_name, is_weekend, trip_type, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, sum(total_amount) AS total_revenue, avg(tip_percentage) AS avg_tip_pct
FROM recent30 GROUP BY 1, 2, 3
""", "avg_fare avg_distance total_revenue avg_tip_pct")

add("daily_performance", lambda b: demand.daily_performance(b.recent(30), b.trips_as_of), """
SELECT pickup_date, trip_type, count(*) AS total_trips, sum(total_amount) AS total_revenue,
  avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct,
  avg(trip_duration_minutes) AS avg_duration, avg(trip_speed_mph) AS avg_speed,
  count(DISTINCT pickup_location_id) AS unique_pickup_zones, count(DISTINCT dropoff_location_id) AS unique_dropoff_zones
FROM recent30 GROUP BY 1, 2
""", "total_revenue avg_fare avg_distance avg_tip_pct avg_duration avg_speed")

add("weekend_vs_weekday", lambda b: demand.weekend_vs_weekday(b.recent(30), b.trips_as_of), f"""
SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period_type, trip_type, count(*) AS trip_count,
  {PERIOD}, sum(total_amount) AS total_revenue
FROM recent30 GROUP BY 1, 2
""", PERIOD_FLOATS + " total_revenue")

add("demand_forecast_features", lambda b: demand.demand_forecast_features(b.recent(30), b.trips_as_of), f"""
SELECT pickup_date, pickup_hour, pickup_day_of_week, {DAY} AS day_name, is_weekend, trip_type,
  count(*) AS trip_count, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare
FROM recent30 GROUP BY ALL
""", "total_revenue avg_fare")

add("hourly_demand_type", lambda b: views.hourly_demand_type(b.trips), """
SELECT pickup_hour, trip_type, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct, avg(trip_speed_mph) AS avg_speed
FROM trips GROUP BY 1, 2
""", "avg_fare avg_distance avg_tip_pct avg_speed")

add("hourly_demand_borough", lambda b: views.hourly_demand_borough(b.tz), """
SELECT pickup_hour, pickup_borough, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(trip_speed_mph) AS avg_speed
FROM tz GROUP BY 1, 2
""", "avg_fare avg_speed")

add("peak_hours_top10", lambda b: demand.peak_hours_top10(b.trips), """
SELECT pickup_hour, count(*) FILTER (trip_type = 'yellow') AS yellow_trips,
  count(*) FILTER (trip_type = 'green') AS green_trips, count(*) AS total_trips, avg(fare_amount) AS avg_fare
FROM trips GROUP BY 1 ORDER BY total_trips DESC, pickup_hour LIMIT 10
""", "avg_fare")

add("peak_indicators", lambda b: demand.peak_indicators(b.trips), f"""
WITH hours AS (SELECT pickup_hour, count(*) AS n FROM trips GROUP BY 1),
days AS (SELECT {DAY} AS day_name, count(*) AS n FROM trips GROUP BY 1)
SELECT 'Peak Performance' AS category,
  (SELECT pickup_hour FROM hours ORDER BY n DESC, pickup_hour LIMIT 1) AS peak_hour,
  (SELECT max(n) FROM hours) AS peak_hour_trips,
  (SELECT day_name FROM days ORDER BY n DESC, day_name LIMIT 1) AS peak_day,
  (SELECT max(n) FROM days) AS peak_day_trips
""")

add("daily_7day_average", lambda b: demand.daily_7day_average(b.trips), """
SELECT pickup_date, trip_type, n AS daily_trips,
  avg(n) OVER (PARTITION BY trip_type ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_7_day
FROM (SELECT pickup_date, trip_type, count(*) AS n FROM trips GROUP BY 1, 2)
""", "avg_7_day")

# --- geography --------------------------------------------------------------

add("top_pickup_zones", lambda b: geo.top_pickup_zones(b.recent(30), b.zones, b.trips_as_of, min_trips=20), """
SELECT z.borough AS pickup_borough, z.zone AS pickup_zone, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, sum(total_amount) AS total_revenue, avg(tip_percentage) AS avg_tip_pct,
  avg(trip_duration_minutes) AS avg_duration_min, count(DISTINCT pickup_date) AS active_days,
  round((count(*) * 100.0 / (SELECT count(*) FROM recent30 r JOIN zones y ON r.pickup_location_id = y.location_id))::DECIMAL(30,9), 2)::DOUBLE
    AS market_share_pct
FROM recent30 t JOIN zones z ON t.pickup_location_id = z.location_id
GROUP BY 1, 2 HAVING count(*) >= 20 ORDER BY trip_count DESC, 1, 2 LIMIT 25
""", "avg_fare avg_distance total_revenue avg_tip_pct avg_duration_min")

add("borough_flows", lambda b: geo.borough_flows(b.recent(30), b.zones, b.trips_as_of, min_trips=20), """
WITH flows AS (
  SELECT p.borough AS pickup_borough, d.borough AS dropoff_borough, count(*) AS trip_count,
    avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
    sum(total_amount) AS total_revenue, avg(tip_percentage) AS avg_tip_pct
  FROM recent30 t JOIN zones p ON t.pickup_location_id = p.location_id
    JOIN zones d ON t.dropoff_location_id = d.location_id
  GROUP BY 1, 2)
SELECT *, round((trip_count * 100.0 / (SELECT sum(trip_count) FROM flows))::DECIMAL(30,9), 2)::DOUBLE AS flow_percentage
FROM flows WHERE trip_count >= 20
""", "avg_fare avg_distance avg_duration total_revenue avg_tip_pct")

AIRPORT = """avg(fare_amount) AS avg_fare, avg(total_amount) AS avg_total, avg(trip_distance) AS avg_distance,
  avg(trip_duration_minutes) AS avg_duration, avg(tip_percentage) AS avg_tip_pct"""
AIRPORT_FLOATS = "avg_fare avg_total avg_distance avg_duration avg_tip_pct"

add("airport_by_airport", lambda b: geo.airport_by_airport(b.recent(30), b.zones, b.trips_as_of), f"""
SELECT CASE WHEN ap.location_id = t.pickup_location_id THEN 'From Airport' ELSE 'To Airport' END AS trip_category,
  ap.zone AS airport_name, ap.borough, trip_type, count(*) AS trip_count, {AIRPORT}
FROM recent30 t JOIN (SELECT * FROM zones WHERE zone LIKE '%Airport%' OR zone LIKE '%JFK%'
    OR zone LIKE '%LaGuardia%' OR zone LIKE '%LGA%' OR zone LIKE '%Newark%') ap
  ON t.pickup_location_id = ap.location_id OR t.dropoff_location_id = ap.location_id
GROUP BY 1, 2, 3, 4
""", AIRPORT_FLOATS)

add("airport_categories", lambda b: geo.airport_categories(b.tz), f"""
SELECT CASE WHEN regexp_matches(pickup_zone, 'Airport|JFK|LaGuardia|LGA|Newark') THEN 'From Airport'
    WHEN regexp_matches(dropoff_zone, 'Airport|JFK|LaGuardia|LGA|Newark') THEN 'To Airport'
    ELSE 'Non-Airport' END AS trip_category, trip_type, count(*) AS trip_count, {AIRPORT}
FROM tz GROUP BY 1, 2
""", AIRPORT_FLOATS)

add("speed_by_borough_hour", lambda b: geo.speed_by_borough_hour(b.recent(30), b.zones, b.trips_as_of, min_trips=3), """
SELECT pickup_hour, z.borough AS pickup_borough, trip_type, count(*) AS trip_count, avg(trip_speed_mph) AS avg_speed,
  avg(trip_duration_minutes) AS avg_duration, quantile_cont(trip_speed_mph, 0.25) AS q1_speed,
  quantile_cont(trip_speed_mph, 0.5) AS median_speed, quantile_cont(trip_speed_mph, 0.75) AS q3_speed
FROM recent30 t JOIN zones z ON t.pickup_location_id = z.location_id
WHERE trip_speed_mph BETWEEN 1 AND 60 GROUP BY 1, 2, 3 HAVING count(*) >= 3
""", "avg_speed avg_duration q1_speed median_speed q3_speed")

add("hourly_efficiency", lambda b: business.hourly_efficiency(b.recent(30), b.trips_as_of), """
WITH hours AS (
  SELECT pickup_date, pickup_hour, trip_type, count(*) AS n, sum(total_amount) AS revenue,
    avg(trip_duration_minutes) AS duration, sum(trip_duration_minutes) AS active,
    stddev_samp(trip_duration_minutes) AS spread
  FROM recent30 GROUP BY 1, 2, 3)
SELECT trip_type, avg(n) AS avg_trips_per_hour, avg(revenue) AS avg_revenue_per_hour, avg(duration) AS avg_trip_duration,
  avg(active) AS avg_active_minutes_per_hour, avg(spread) AS avg_duration_variability
FROM hours GROUP BY 1
""", "avg_trips_per_hour avg_revenue_per_hour avg_trip_duration avg_active_minutes_per_hour avg_duration_variability")

add("route_efficiency", lambda b: geo.route_efficiency(b.recent(30), b.zones, b.trips_as_of, min_trips=2), """
WITH pairs AS (
  SELECT pickup_location_id AS p_id, dropoff_location_id AS d_id, count(*) AS trip_count, avg(trip_distance) AS m1,
    avg(trip_duration_minutes) AS m2, avg(trip_speed_mph) AS m3, avg(fare_per_mile) AS m4,
    stddev_samp(trip_duration_minutes) AS m5
  FROM recent30 WHERE trip_speed_mph BETWEEN 1 AND 60 GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT p.zone AS pickup_zone, d.zone AS dropoff_zone, p.borough AS pickup_borough, d.borough AS dropoff_borough,
  trip_count, round(m1::DECIMAL(30,9), 2)::DOUBLE AS avg_distance, round(m2::DECIMAL(30,9), 1)::DOUBLE AS avg_duration_min, round(m3::DECIMAL(30,9), 1)::DOUBLE AS avg_speed_mph,
  round(m4::DECIMAL(30,9), 2)::DOUBLE AS avg_fare_per_mile, round(m5::DECIMAL(30,9), 1)::DOUBLE AS duration_variability
FROM pairs JOIN zones p ON p_id = p.location_id JOIN zones d ON d_id = d.location_id
ORDER BY trip_count DESC, p_id, d_id LIMIT 50
""")

add("zone_efficiency_ranks", lambda b: geo.zone_efficiency_ranks(b.tz, min_trips=500), """
WITH z AS (
  SELECT pickup_zone, pickup_borough, count(*) AS trip_count, avg(trip_speed_mph) AS speed, avg(fare_per_mile) AS mile,
    avg(tip_percentage) AS tip, sum(total_amount) AS revenue
  FROM tz WHERE pickup_zone IS NOT NULL AND trip_speed_mph BETWEEN 1 AND 60 GROUP BY 1, 2 HAVING count(*) >= 500)
SELECT pickup_zone, pickup_borough, trip_count, round(speed::DECIMAL(30,9), 2)::DOUBLE AS avg_speed_mph, round(mile::DECIMAL(30,9), 2)::DOUBLE AS avg_fare_per_mile,
  round(tip::DECIMAL(30,9), 2)::DOUBLE AS avg_tip_pct, round(revenue::DECIMAL(30,9), 2)::DOUBLE AS total_revenue,
  CAST(row_number() OVER (ORDER BY speed DESC, pickup_zone, pickup_borough) AS INT) AS speed_rank,
  CAST(row_number() OVER (ORDER BY mile DESC, pickup_zone, pickup_borough) AS INT) AS fare_rank,
  CAST(row_number() OVER (ORDER BY revenue DESC, pickup_zone, pickup_borough) AS INT) AS revenue_rank
FROM z ORDER BY speed_rank LIMIT 20
""")

add("revenue_by_borough", lambda b: geo.revenue_by_borough(joins.trips_with_zones(b.recent(30), b.zones), b.trips_as_of), """
SELECT z.borough, trip_type, count(*) AS total_trips, sum(total_amount) AS total_revenue,
  avg(total_amount) AS avg_revenue_per_trip, sum(tip_amount) AS total_tips, avg(tip_percentage) AS avg_tip_percentage,
  count(DISTINCT pickup_date) AS active_days
FROM recent30 t JOIN zones z ON t.pickup_location_id = z.location_id GROUP BY 1, 2
""", "total_revenue avg_revenue_per_trip total_tips avg_tip_percentage")

# --- payments, fares, anomalies ---------------------------------------------

add("payment_tips", lambda b: business.payment_tips(b.recent(30), b.trips_as_of), f"""
SELECT {PAYMENT} AS payment_method, trip_type, count(*) AS trip_count,
  round((count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY trip_type))::DECIMAL(30,9), 2)::DOUBLE AS pct_of_type,
  sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip_amount,
  avg(tip_percentage) AS avg_tip_pct, quantile_cont(tip_percentage, 0.5) AS median_tip_pct,
  quantile_cont(tip_percentage, 0.95) AS p95_tip_pct
FROM recent30 GROUP BY payment_type, trip_type
""", "total_revenue avg_fare avg_tip_amount avg_tip_pct median_tip_pct p95_tip_pct")

add("fare_by_distance_band", lambda b: business.fare_by_distance_band(b.recent(30), b.trips_as_of), f"""
SELECT {BAND} AS distance_band, trip_type, count(*) AS trip_count, avg(trip_distance) AS avg_distance,
  avg(fare_amount) AS avg_fare, avg(fare_per_mile) AS avg_fare_per_mile, avg(total_amount) AS avg_total,
  avg(trip_duration_minutes) AS avg_duration, avg(trip_speed_mph) AS avg_speed,
  quantile_cont(fare_per_mile, 0.5) AS median_fare_per_mile
FROM recent30 GROUP BY 1, 2
""", "avg_distance avg_fare avg_fare_per_mile avg_total avg_duration avg_speed median_fare_per_mile")

add("rate_code_analysis", lambda b: business.rate_code_analysis(b.recent(30), b.trips_as_of), f"""
SELECT {RATE} AS rate_type, trip_type, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  avg(total_amount) AS avg_total, avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration
FROM recent30 GROUP BY rate_code_id, trip_type
""", "avg_fare avg_total avg_distance avg_duration")

add("tip_by_period", lambda b: business.tip_by_period(b.trips), f"""
SELECT {PART} AS time_period, trip_type, count(*) AS trip_count, avg(tip_amount) AS avg_tip_amount,
  avg(tip_percentage) AS avg_tip_pct, quantile_cont(tip_percentage, 0.5) AS median_tip_pct,
  quantile_cont(tip_percentage, 0.95) AS p95_tip_pct
FROM trips WHERE payment_type = 1 GROUP BY 1, 2
""", "avg_tip_amount avg_tip_pct median_tip_pct p95_tip_pct")

FARE_PERCENTILES = """
SELECT trip_type, count(*) AS total_trips, round(avg(fare_amount)::DECIMAL(30,9), 2)::DOUBLE AS mean_fare,
  round(stddev_samp(fare_amount)::DECIMAL(30,9), 2)::DOUBLE AS stddev_fare,
  round(quantile_cont(fare_amount, 0.1)::DECIMAL(30,9), 2)::DOUBLE AS p10_fare, round(quantile_cont(fare_amount, 0.25)::DECIMAL(30,9), 2)::DOUBLE AS p25_fare,
  round(quantile_cont(fare_amount, 0.5)::DECIMAL(30,9), 2)::DOUBLE AS median_fare, round(quantile_cont(fare_amount, 0.75)::DECIMAL(30,9), 2)::DOUBLE AS p75_fare,
  round(quantile_cont(fare_amount, 0.9)::DECIMAL(30,9), 2)::DOUBLE AS p90_fare, round(quantile_cont(fare_amount, 0.95)::DECIMAL(30,9), 2)::DOUBLE AS p95_fare,
  round(quantile_cont(fare_amount, 0.99)::DECIMAL(30,9), 2)::DOUBLE AS p99_fare
FROM trips GROUP BY 1
"""
add("fare_percentiles", lambda b: business.fare_percentiles(b.trips), FARE_PERCENTILES)
# The same report by the way taken beyond the size limit.
add("fare_percentiles_ranges", lambda b: business.fare_percentiles(b.trips), FARE_PERCENTILES)

add("fare_zscore_by_type", lambda b: business.fare_zscore_by_type(b.recent(7), b.trips_as_of), """
WITH s AS (SELECT trip_type, avg(fare_per_mile) AS avg_fare_per_mile, stddev_samp(fare_per_mile) AS stddev_fare_per_mile
  FROM recent7 WHERE fare_per_mile > 0 GROUP BY 1)
SELECT trip_key, pickup_datetime, t.trip_type, fare_amount, trip_distance, fare_per_mile, total_amount,
  avg_fare_per_mile, stddev_fare_per_mile,
  abs(fare_per_mile - avg_fare_per_mile) / nullif(stddev_fare_per_mile, 0) AS fare_z_score,
  CASE WHEN abs(fare_per_mile - avg_fare_per_mile) / nullif(stddev_fare_per_mile, 0) > 3 THEN 'Anomaly' ELSE 'Outlier' END
    AS fare_classification
FROM recent7 t JOIN s ON t.trip_type = s.trip_type
WHERE abs(fare_per_mile - avg_fare_per_mile) / nullif(stddev_fare_per_mile, 0) > 2
""", "fare_per_mile avg_fare_per_mile stddev_fare_per_mile fare_z_score")

add("fare_anomaly_rules", lambda b: business.fare_anomaly_rules(b.recent(7), b.trips_as_of), """
WITH s AS (SELECT avg(fare_per_mile) AS m1, stddev_samp(fare_per_mile) AS s1, avg(total_amount) AS m2,
    stddev_samp(total_amount) AS s2 FROM recent7 WHERE fare_per_mile > 0),
scored AS (SELECT *, (fare_per_mile - m1) / nullif(s1, 0) AS z1, (total_amount - m2) / nullif(s2, 0) AS z2
  FROM recent7 CROSS JOIN s)
SELECT trip_key, pickup_datetime, pickup_location_id, dropoff_location_id, trip_distance, fare_amount, total_amount,
  fare_per_mile, trip_duration_minutes, payment_type, round(z1::DECIMAL(30,9), 2)::DOUBLE AS fare_per_mile_zscore,
  round(z2::DECIMAL(30,9), 2)::DOUBLE AS total_amount_zscore,
  CASE WHEN abs(z1) > 3 THEN 'High Fare Anomaly' WHEN abs(z2) > 3 THEN 'High Total Anomaly'
    WHEN trip_duration_minutes < 2 AND trip_distance > 1 THEN 'Suspiciously Fast' ELSE 'Unrealistic Speed' END AS anomaly_type
FROM scored
WHERE abs(z1) > 3 OR abs(z2) > 3 OR (trip_duration_minutes < 2 AND trip_distance > 1) OR trip_speed_mph > 80
ORDER BY pickup_datetime DESC, trip_key, total_amount LIMIT 100
""", "fare_per_mile trip_duration_minutes")

# --- management reports -----------------------------------------------------

add("market_share", lambda b: business.market_share(b.recent(30), b.trips_as_of), """
SELECT trip_type, count(*) AS trip_count, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, avg(tip_percentage) AS avg_tip_pct,
  round((count(*) * 100.0 / sum(count(*)) OVER ())::DECIMAL(30,9), 2)::DOUBLE AS trip_market_share_pct,
  round((sum(total_amount) * 100 / sum(sum(total_amount)) OVER ())::DECIMAL(30,9), 2)::DOUBLE AS revenue_market_share_pct
FROM recent30 GROUP BY 1
""", "total_revenue avg_fare avg_distance avg_tip_pct")

add("exec_dashboard", lambda b: business.exec_dashboard(b.recent(30), b.trips_as_of), """
WITH d AS (SELECT pickup_date, count(*) AS n, sum(total_amount) AS revenue, avg(fare_amount) AS fare,
    count(DISTINCT pickup_location_id) AS z FROM recent30 GROUP BY 1),
g AS (SELECT *, lag(n) OVER (ORDER BY pickup_date) AS p FROM d)
SELECT 'Last 30 Days Summary' AS metric_group, sum(n)::BIGINT AS total_trips, sum(revenue) AS total_revenue,
  avg(fare) AS avg_fare, avg(z) AS avg_zones_per_day, max(n) AS peak_day_trips, min(n) AS min_day_trips,
  avg(n) AS avg_daily_trips, round((avg((n - p) * CAST(100 AS DOUBLE) / p))::DECIMAL(30,9), 2)::DOUBLE AS avg_daily_growth_pct
FROM g
""", "total_revenue avg_fare avg_zones_per_day avg_daily_trips")

add("exec_summary", lambda b: business.exec_summary(b.trips), """
SELECT 'Overall Performance' AS metric_category, count(*) AS total_trips, round(sum(total_amount)::DECIMAL(30,9), 2)::DOUBLE AS total_revenue,
  round(avg(fare_amount)::DECIMAL(30,9), 2)::DOUBLE AS avg_fare, round(avg(trip_distance)::DECIMAL(30,9), 2)::DOUBLE AS avg_distance,
  round(avg(tip_percentage)::DECIMAL(30,9), 2)::DOUBLE AS avg_tip_pct, count(DISTINCT pickup_location_id) AS unique_pickup_zones,
  count(DISTINCT dropoff_location_id) AS unique_dropoff_zones, round(avg(trip_speed_mph)::DECIMAL(30,9), 2)::DOUBLE AS avg_speed_mph
FROM trips
""")

add("revenue_by_payment", lambda b: business.revenue_by_payment(b.trips), f"""
SELECT {PAYMENT} AS payment_method, round(sum(total_amount)::DECIMAL(30,9), 2)::DOUBLE AS total_revenue,
  round((sum(total_amount) * 100 / sum(sum(total_amount)) OVER ())::DECIMAL(30,9), 2)::DOUBLE AS revenue_share_pct,
  round(avg(tip_percentage)::DECIMAL(30,9), 2)::DOUBLE AS avg_tip_pct
FROM trips GROUP BY 1
""")

BENCHMARKS = """
SELECT 'Performance Benchmarks' AS category, round(quantile_cont(trip_speed_mph, 0.5)::DECIMAL(30,9), 2)::DOUBLE AS median_speed_mph,
  round(quantile_cont(fare_per_mile, 0.5)::DECIMAL(30,9), 2)::DOUBLE AS median_fare_per_mile,
  round(quantile_cont(tip_percentage, 0.5)::DECIMAL(30,9), 2)::DOUBLE AS median_tip_pct,
  round(quantile_cont(trip_duration_minutes, 0.5)::DECIMAL(30,9), 2)::DOUBLE AS median_duration_min,
  count(DISTINCT CASE WHEN pickup_hour IN (7, 8, 9, 17, 18, 19) THEN pickup_date END) AS rush_hour_days,
  count(DISTINCT pickup_date) AS total_days
FROM trips
"""
add("benchmarks", lambda b: business.benchmarks(b.trips), BENCHMARKS)
add("benchmarks_ranges", lambda b: business.benchmarks(b.trips), BENCHMARKS)

# --- parameterised functions ------------------------------------------------

add("get_trip_summary", lambda b: business.get_trip_summary(b.trips, "1998-01-01", "1999-12-31", "yellow"), """
SELECT count(*) AS total_trips, sum(total_amount) AS total_revenue, avg(fare_amount) AS avg_fare,
  avg(trip_distance) AS avg_distance, avg(trip_duration_minutes) AS avg_duration,
  count(DISTINCT pickup_location_id) AS unique_zones
FROM trips WHERE pickup_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31' AND trip_type = 'yellow'
""", "total_revenue avg_fare avg_distance avg_duration")

add("get_top_pickup_zones", lambda b: geo.get_top_pickup_zones(b.trips, b.zones, 10, "1998-01-01"), """
SELECT z.zone AS zone_name, z.borough, count(*) AS trip_count, avg(fare_amount) AS avg_fare,
  sum(total_amount) AS total_revenue
FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
WHERE pickup_date >= DATE '1998-01-01' GROUP BY 1, 2 ORDER BY trip_count DESC, 1, 2 LIMIT 10
""", "avg_fare total_revenue")

# --- wide tables --------------------------------------------------------------

TYPES = ("yellow", "green")

add("weekday_trips_pivot", lambda b: demand.weekday_pivot(b.trips, TYPES), f"""
SELECT {DAY} AS day_name, count(*) FILTER (trip_type = 'yellow') AS yellow, count(*) FILTER (trip_type = 'green') AS green
FROM trips GROUP BY 1
""")
add("weekday_revenue_pivot", lambda b: demand.weekday_pivot(b.trips, TYPES, "total_amount"), f"""
SELECT {DAY} AS day_name, coalesce(sum(total_amount) FILTER (trip_type = 'yellow'), 0) AS yellow,
  coalesce(sum(total_amount) FILTER (trip_type = 'green'), 0) AS green FROM trips GROUP BY 1
""", "yellow green")
add("payment_trips_pivot", lambda b: demand.payment_pivot(b.trips, TYPES), f"""
SELECT {PAYMENT} AS payment_method, count(*) FILTER (trip_type = 'yellow') AS yellow,
  count(*) FILTER (trip_type = 'green') AS green FROM trips GROUP BY 1
""")
