"""Named analyses over the ride service."""

from __future__ import annotations

from cabrank.operators import ml
from cabrank.plans import ride_business as business
from cabrank.plans import ride_demand as demand
from cabrank.plans import ride_drivers as drivers
from cabrank.registry.base import AS_OF, add

RECENT = f"pickup_datetime >= {AS_OF} - INTERVAL 30 DAY"
NAMED = "JOIN zones z ON pickup_zone_id = z.location_id"


def idle_days(column: str) -> str:
    return f"CAST(floor((epoch({AS_OF}) - epoch({column})) / 86400) AS INT)"


# --- demand -----------------------------------------------------------------

add("ride_hourly_demand_view", lambda b: demand.ride_hourly_demand_view(b.rides), """
SELECT date_trunc('hour', pickup_datetime) AS hour, pickup_zone_id, count(*) AS trip_count,
  avg(total_fare) AS avg_fare, avg(trip_distance) AS avg_distance
FROM completed GROUP BY 1, 2
""", "avg_fare avg_distance")

add("hourly_zone_demand", lambda b: demand.hourly_zone_demand(b.rides, b.zones), f"""
WITH h AS (
  SELECT date_trunc('hour', pickup_datetime) AS hr, pickup_zone_id, z.zone AS zone_name, z.area_type,
    count(*) AS n, avg(total_fare) AS fare, avg(surge_multiplier) AS surge, avg(wait_time) AS wait
  FROM completed {NAMED} GROUP BY 1, 2, 3, 4)
SELECT CAST(hour(hr) AS INT) AS hour_of_day, dayname(hr) AS day_name, zone_name, area_type, avg(n) AS avg_trips,
  avg(fare) AS avg_fare, avg(surge) AS avg_surge_multiplier, avg(wait) AS avg_wait_seconds
FROM h GROUP BY 1, 2, 3, 4
""", "avg_trips avg_fare avg_surge_multiplier avg_wait_seconds")

add("surge_opportunities", lambda b: demand.surge_opportunities(b.rides, b.zones, b.rides_as_of, min_demand=3), f"""
WITH d AS (
  SELECT date_trunc('hour', pickup_datetime) AS hour, pickup_zone_id, count(DISTINCT ride_id) AS demand,
    count(DISTINCT driver_id) AS supply, avg(wait_time) AS avg_wait, avg(total_fare) AS avg_fare
  FROM rides WHERE {RECENT} GROUP BY 1, 2)
SELECT hour, z.zone AS zone_name, demand, supply, round((demand / supply)::DECIMAL(30,9), 2)::DOUBLE AS demand_supply_ratio,
  avg_wait, avg_fare, CASE WHEN demand / supply > 3 THEN 'High Surge Recommended'
    WHEN demand / supply > 2 THEN 'Moderate Surge Recommended'
    WHEN demand / supply > 1.5::DOUBLE THEN 'Low Surge Recommended' ELSE 'No Surge Needed' END AS surge_recommendation
FROM d {NAMED} WHERE demand > 3
""", "avg_wait avg_fare")

RATIOS = f"""ratios AS (
  SELECT CAST(hour(pickup_datetime) AS INT) AS hour, z.zone AS zone_name, count(ride_id) AS demand,
    count(DISTINCT driver_id) AS supply, avg(total_fare) AS avg_fare, avg(surge_multiplier) AS avg_surge,
    avg(wait_time) AS avg_wait, count(ride_id) / greatest(count(DISTINCT driver_id), 1) AS demand_supply_ratio
  FROM rides {NAMED} GROUP BY 1, 2)"""

add("surge_by_hour_zone",
    lambda b: demand.surge_by_hour_zone(demand.hour_zone_ratio(b.rides, b.zones), threshold=1.1), f"""
WITH {RATIOS}, hours AS (SELECT hour, avg(demand_supply_ratio) AS hour_avg_ratio FROM ratios GROUP BY 1)
SELECT * FROM (SELECT * FROM ratios WHERE demand_supply_ratio > 1.1::DOUBLE
  ORDER BY demand_supply_ratio DESC, hour, zone_name LIMIT 20) JOIN hours USING (hour)
""", "avg_fare avg_surge avg_wait demand_supply_ratio hour_avg_ratio")

add("surge_uplift", lambda b: demand.surge_uplift(demand.hour_zone_ratio(b.rides, b.zones), threshold=1.1), f"""
WITH {RATIOS}
SELECT sum(demand * avg_fare) AS current_revenue, sum(demand * avg_fare * 1.5::DOUBLE) AS potential_revenue,
  (sum(demand * avg_fare * 1.5::DOUBLE) - sum(demand * avg_fare)) * 100 / sum(demand * avg_fare) AS revenue_increase_pct
FROM ratios WHERE demand_supply_ratio > 1.1::DOUBLE
""", "current_revenue potential_revenue revenue_increase_pct")

add("surge_trend_line", lambda b: ml.trend_line(demand.hour_zone_ratio(b.rides, b.zones), "demand_supply_ratio", "avg_surge"),
    f"""
WITH {RATIOS}
SELECT regr_slope(avg_surge, demand_supply_ratio) AS slope, regr_intercept(avg_surge, demand_supply_ratio) AS intercept
FROM ratios
""", "slope intercept")

# --- weather ----------------------------------------------------------------

IMPACT = """impact AS (
  SELECT weather_condition, count(ride_id) AS total_trips, avg(total_fare) AS avg_fare,
    avg(surge_multiplier) AS avg_surge, avg(wait_time) AS avg_wait_time, stddev_samp(total_fare) AS fare_stddev
  FROM completed r JOIN weather w ON r.pickup_zone_id = w.zone_id
    AND date_trunc('hour', r.pickup_datetime) = date_trunc('hour', w.datetime)
  GROUP BY 1)"""

add("weather_impact", lambda b: demand.weather_impact(b.rides, b.weather), f"WITH {IMPACT} SELECT * FROM impact",
    "avg_fare avg_surge avg_wait_time fare_stddev")

add("weather_surge_contrast", lambda b: demand.weather_surge_contrast(demand.weather_impact(b.rides, b.weather)), f"""
WITH {IMPACT}
SELECT avg(avg_surge) FILTER (weather_condition IN ('Rain', 'Heavy Rain', 'Snow')) AS bad_weather_surge,
  max(avg_surge) FILTER (weather_condition = 'Clear') AS clear_weather_surge
FROM impact
""", "bad_weather_surge clear_weather_surge")

add("temperature_demand", lambda b: demand.temperature_demand(b.rides, b.weather), """
SELECT temperature, count(ride_id) AS trip_count
FROM rides r JOIN weather w ON r.pickup_zone_id = w.zone_id
  AND date_trunc('hour', r.pickup_datetime) = date_trunc('hour', w.datetime)
GROUP BY 1
""", "temperature")

# --- calendar ---------------------------------------------------------------

HOURLY = """
SELECT CAST(hour(pickup_datetime) AS INT) AS hour, count(ride_id) AS trip_count, avg(total_fare) AS avg_fare,
  avg(surge_multiplier) AS avg_surge, avg(wait_time) AS avg_wait_time
FROM rides GROUP BY 1"""

add("ride_hourly_demand", lambda b: demand.ride_hourly_demand(b.rides), HOURLY, "avg_fare avg_surge avg_wait_time")
add("ride_peak_hours", lambda b: demand.ride_peak_hours(b.rides),
    HOURLY + " ORDER BY trip_count DESC, hour LIMIT 5", "avg_fare avg_surge avg_wait_time")

add("ride_daily_demand", lambda b: demand.ride_daily_demand(b.rides), """
SELECT CAST(isodow(pickup_datetime) - 1 AS INT) AS day_of_week, dayname(pickup_datetime) AS day_name,
  count(ride_id) AS trip_count, avg(total_fare) AS avg_fare, avg(trip_distance) AS avg_distance,
  avg(passenger_count) AS avg_passengers
FROM rides GROUP BY 1, 2
""", "avg_fare avg_distance avg_passengers")

add("ride_weekend_comparison", lambda b: demand.ride_weekend_comparison(b.rides), """
SELECT CASE WHEN isodow(pickup_datetime) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS period_type,
  count(ride_id) AS trip_count, avg(total_fare) AS avg_fare, avg(surge_multiplier) AS avg_surge
FROM rides GROUP BY 1
""", "avg_fare avg_surge")

add("ride_zone_demand", lambda b: demand.ride_zone_demand(b.rides, b.zones), f"""
SELECT z.zone AS zone_name, z.area_type, count(ride_id) AS trip_count, avg(total_fare) AS avg_fare,
  avg(wait_time) AS avg_wait_time, avg(surge_multiplier) AS avg_surge
FROM rides {NAMED} GROUP BY 1, 2 ORDER BY trip_count DESC, 1, 2 LIMIT 15
""", "avg_fare avg_wait_time avg_surge")

add("ride_area_demand", lambda b: demand.ride_area_demand(b.rides, b.zones), f"""
SELECT z.area_type, count(ride_id) AS trip_count FROM rides {NAMED} GROUP BY 1
""")

PER_DAY = "d AS (SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(ride_id) AS trip_count FROM rides GROUP BY 1)"

add("ride_moving_average", lambda b: demand.ride_moving_average(b.rides), f"""
WITH {PER_DAY}
SELECT *, avg(trip_count) OVER (ORDER BY trip_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma_7,
  avg(trip_count) OVER (ORDER BY trip_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS ma_14
FROM d
""", "ma_7 ma_14")

add("ride_wow_trend", lambda b: demand.ride_wow_trend(b.rides), f"""
WITH {PER_DAY}, n AS (SELECT *, row_number() OVER (ORDER BY trip_date DESC) AS back FROM d),
m AS (SELECT avg(trip_count) FILTER (back <= 7) AS last_avg, avg(trip_count) FILTER (back BETWEEN 8 AND 14) AS previous_avg
  FROM n)
SELECT *, (last_avg - previous_avg) / previous_avg * 100 AS trend_pct FROM m
""", "last_avg previous_avg trend_pct")

# --- drivers ----------------------------------------------------------------

METRICS = """metrics AS (
  SELECT r.driver_id, count(ride_id) AS total_trips, sum(total_fare) AS total_revenue, avg(total_fare) AS avg_fare,
    sum(trip_distance) AS total_distance, avg(trip_distance) AS avg_distance, avg(trip_duration) AS avg_duration,
    avg(customer_rating) AS avg_customer_rating, sum(tips) AS total_tips, avg(tips) AS avg_tips,
    avg(route_efficiency) AS avg_route_efficiency, avg(wait_time) AS avg_wait_time,
    max(pickup_datetime) AS last_trip_date
  FROM completed r GROUP BY 1)"""

add("top_drivers", lambda b: drivers.top_drivers(b.drivers, b.rides, b.rides_as_of), f"""
SELECT first_name || ' ' || last_name AS driver_name, any_value(rating) AS driver_rating, count(ride_id) AS total_trips,
  round(sum(total_fare)::DECIMAL(30,9), 2)::DOUBLE AS total_revenue,
  round(avg(total_fare)::DECIMAL(30,9), 2)::DOUBLE AS avg_fare,
  round(avg(trip_distance)::DECIMAL(30,9), 2)::DOUBLE AS avg_distance_miles,
  round(avg(customer_rating)::DECIMAL(30,9), 2)::DOUBLE AS avg_customer_rating,
  round(sum(tips)::DECIMAL(30,9), 2)::DOUBLE AS total_tips, round(avg(tips)::DECIMAL(30,9), 2)::DOUBLE AS avg_tips,
  round(avg(route_efficiency)::DECIMAL(30,9), 2)::DOUBLE AS route_efficiency,
  round((sum(total_fare) / count(ride_id))::DECIMAL(30,9), 2)::DOUBLE AS revenue_per_trip
FROM drivers d JOIN completed r ON d.driver_id = r.driver_id WHERE {RECENT}
GROUP BY d.driver_id, 1 ORDER BY sum(total_fare) DESC, d.driver_id LIMIT 20
""", "driver_rating")

add("driver_extra_metrics", lambda b: drivers.driver_metrics(b.drivers, b.rides).select(
    "driver_id", "driver_name", "total_trips", "total_revenue", "total_distance", "avg_fare", "avg_customer_rating",
    "rating", "status", "revenue_per_mile", "trips_per_day"), f"""
WITH {METRICS}
SELECT m.driver_id, first_name || ' ' || last_name AS driver_name, total_trips, total_revenue, total_distance, avg_fare,
  avg_customer_rating, rating, status, total_revenue / greatest(total_distance, 1) AS revenue_per_mile,
  total_trips / CAST(30 AS DOUBLE) AS trips_per_day
FROM metrics m LEFT JOIN drivers d ON m.driver_id = d.driver_id
""", "total_revenue total_distance avg_fare avg_customer_rating revenue_per_mile trips_per_day")

SHIFTS = """shifts AS (
  SELECT driver_id, CAST(pickup_datetime AS DATE) AS work_date, count(*) AS n, sum(trip_duration) AS driving,
    sum(total_fare) AS earnings, epoch(max(dropoff_datetime)) - epoch(min(pickup_datetime)) AS span
  FROM completed GROUP BY 1, 2)"""

add("driver_utilization", lambda b: drivers.driver_utilization(b.drivers, b.rides, b.rides_as_of), f"""
WITH {SHIFTS}
SELECT s.driver_id, any_value(first_name || ' ' || last_name) AS driver_name, count(DISTINCT work_date) AS days_worked,
  avg(n) AS avg_trips_per_day, avg(span / 3600) AS avg_hours_per_day,
  avg(driving / CAST(3600 AS DOUBLE)) AS avg_driving_hours, avg(earnings) AS avg_daily_earnings,
  sum(earnings) AS total_earnings, avg(driving / nullif(span, 0)) AS utilization_rate
FROM shifts s JOIN drivers d ON s.driver_id = d.driver_id WHERE work_date >= DATE '2024-01-31' - 30 GROUP BY 1
""", "avg_trips_per_day avg_hours_per_day avg_driving_hours avg_daily_earnings total_earnings utilization_rate")

PCT = f"""{SHIFTS}, pct AS (
  SELECT driver_id, avg(n) AS daily_trips, avg(earnings) AS daily_revenue, avg(span / 3600) AS working_hours,
    avg(driving / CAST(3600 AS DOUBLE)) AS driving_hours,
    avg(driving / CAST(3600 AS DOUBLE) / greatest(span / 3600, 0.1::DOUBLE) * 100) AS utilization_rate,
    avg(n) / greatest(avg(span / 3600), 1) AS trips_per_hour
  FROM shifts GROUP BY 1)"""

add("driver_utilization_pct", lambda b: drivers.driver_utilization_pct(b.rides), f"WITH {PCT} SELECT * FROM pct",
    "daily_trips daily_revenue working_hours driving_hours utilization_rate trips_per_hour")

add("utilization_summary", lambda b: drivers.utilization_summary(drivers.driver_utilization_pct(b.rides)), f"""
WITH {PCT}
SELECT count(*) AS driver_count, avg(working_hours) AS avg_working_hours, avg(driving_hours) AS avg_driving_hours,
  avg(utilization_rate) AS avg_utilization_rate, avg(trips_per_hour) AS avg_trips_per_hour,
  count(*) FILTER (utilization_rate < 50) AS drivers_below_50, count(*) FILTER (utilization_rate < 40) AS drivers_below_40,
  50 - avg(utilization_rate) AS improvement_opportunity
FROM pct
""", "avg_working_hours avg_driving_hours avg_utilization_rate avg_trips_per_hour improvement_opportunity")

add("driver_churn_sql", lambda b: drivers.driver_churn_sql(b.drivers, b.rides, b.rides_as_of), f"""
WITH x AS (
  SELECT d.driver_id, first_name || ' ' || last_name AS driver_name, status, rating, max(pickup_datetime) AS last_ride,
    count(ride_id) AS trips_last_30_days, avg(total_fare) AS avg_fare_last_30_days, avg(customer_rating) AS avg_customer_rating
  FROM drivers d LEFT JOIN rides r ON d.driver_id = r.driver_id AND {RECENT}
  WHERE status = 'Active' GROUP BY 1, 2, 3, 4 HAVING count(ride_id) > 0)
SELECT * EXCLUDE (last_ride), {idle_days('last_ride')} AS days_since_last_trip,
  CASE WHEN {idle_days('last_ride')} > 14 THEN 'High Risk' WHEN {idle_days('last_ride')} > 7 THEN 'Medium Risk'
    ELSE 'Low Risk' END AS churn_risk
FROM x
""", "avg_fare_last_30_days avg_customer_rating")

# All drivers of the test data ride until the end of January; five weeks later some are at risk.
LATER = "2024-03-06 00:00:00"
LEVELS = f"""{METRICS}, idle AS (
  SELECT *, CAST(floor((epoch(TIMESTAMP '{LATER}') - epoch(last_trip_date)) / 86400) AS INT) AS days_since_last_trip
  FROM metrics m LEFT JOIN (SELECT driver_id AS d_id, first_name || ' ' || last_name AS driver_name FROM drivers) d
    ON m.driver_id = d.d_id),
levels AS (
  SELECT *, CASE WHEN days_since_last_trip IS NULL THEN 'No Trips' WHEN days_since_last_trip <= 7 THEN 'Active'
    WHEN days_since_last_trip <= 14 THEN 'Low Risk' WHEN days_since_last_trip <= 30 THEN 'Medium Risk'
    ELSE 'High Risk' END AS churn_risk FROM idle)"""


def churn(b):
    return drivers.churn_levels(drivers.driver_metrics(b.drivers, b.rides), LATER)


add("driver_churn_levels", lambda b: drivers.driver_churn_levels(churn(b)), f"""
WITH {LEVELS} SELECT churn_risk, count(*) AS driver_count FROM levels GROUP BY 1
""")

add("churn_by_level_profile", lambda b: drivers.churn_by_level_profile(churn(b)), f"""
WITH {LEVELS}, p AS (
  SELECT churn_risk, avg(avg_customer_rating) AS avg_customer_rating, avg(avg_fare) AS avg_fare, avg(total_trips) AS avg_trips,
    sum(CASE WHEN churn_risk IN ('Medium Risk', 'High Risk') THEN total_revenue ELSE 0 END) AS at_risk_revenue
  FROM levels GROUP BY 1)
SELECT *, at_risk_revenue * 0.7::DOUBLE AS retained_value FROM p
""", "avg_customer_rating avg_fare avg_trips at_risk_revenue retained_value")

add("at_risk_performers", lambda b: drivers.at_risk_performers(churn(b), min_rating=3.0), f"""
WITH {LEVELS}
SELECT driver_id, driver_name, total_trips, total_revenue, avg_customer_rating, days_since_last_trip, churn_risk
FROM levels WHERE churn_risk IN ('Medium Risk', 'High Risk') AND avg_customer_rating > 3
  AND total_revenue > (SELECT quantile_cont(total_revenue, 0.5) FROM levels)
""", "total_revenue avg_customer_rating")

add("weekly_performance", lambda b: drivers.weekly_performance(b.rides), """
WITH w AS (
  SELECT CAST(date_trunc('week', pickup_datetime) AS DATE) AS week_start, driver_id, count(ride_id) AS n,
    sum(total_fare) AS revenue, avg(customer_rating) AS rating
  FROM completed GROUP BY 1, 2)
SELECT week_start, sum(n)::BIGINT AS weekly_trips, sum(revenue) AS weekly_revenue, avg(rating) AS avg_customer_rating
FROM w GROUP BY 1
""", "weekly_revenue avg_customer_rating")

add("low_rating_drivers", lambda b: drivers.low_rating_drivers(drivers.driver_metrics(b.drivers, b.rides)), f"""
WITH {METRICS}
SELECT count(*) AS driver_count, count(*) FILTER (status = 'Active') AS active_drivers,
  count(*) FILTER (avg_customer_rating < 4) AS low_rating_drivers, avg(total_trips) AS avg_trips_per_driver,
  avg(total_revenue) AS avg_revenue_per_driver, avg(avg_customer_rating) AS avg_customer_rating
FROM metrics m LEFT JOIN drivers d ON m.driver_id = d.driver_id
""", "avg_trips_per_driver avg_revenue_per_driver avg_customer_rating")

# --- routes, customers, revenue ---------------------------------------------

add("profitable_routes", lambda b: business.profitable_routes(b.rides, b.zones, min_trips=20), """
WITH r AS (
  SELECT p.zone AS pickup_zone, d.zone AS dropoff_zone, count(*) AS trip_count, avg(total_fare) AS fare,
    avg(trip_distance) AS dist, avg(trip_duration / CAST(60 AS DOUBLE)) AS dur,
    avg(total_fare / nullif(trip_distance, 0)) AS mile, avg(route_efficiency) AS eff
  FROM completed t JOIN zones p ON t.pickup_zone_id = p.location_id JOIN zones d ON t.dropoff_zone_id = d.location_id
  GROUP BY 1, 2 HAVING count(*) > 20)
SELECT pickup_zone, dropoff_zone, trip_count, round(fare::DECIMAL(30,9), 2)::DOUBLE AS avg_fare,
  round(dist::DECIMAL(30,9), 2)::DOUBLE AS avg_distance_miles, round(dur::DECIMAL(30,9), 2)::DOUBLE AS avg_duration_min,
  round(mile::DECIMAL(30,9), 2)::DOUBLE AS fare_per_mile, round(eff::DECIMAL(30,9), 2)::DOUBLE AS route_efficiency
FROM r ORDER BY fare DESC, trip_count DESC, 1, 2 LIMIT 25
""")

add("traffic_by_hour", lambda b: business.traffic_by_hour(b.rides), """
SELECT CAST(hour(pickup_datetime) AS INT) AS hour, avg(trip_distance / (trip_duration / CAST(3600 AS DOUBLE))) AS avg_speed_mph,
  avg(trip_duration / CAST(60 AS DOUBLE)) AS avg_trip_duration_min, avg(route_efficiency) AS avg_route_efficiency,
  count(*) AS total_trips
FROM completed WHERE trip_duration > 0 AND trip_distance > 0 GROUP BY 1
""", "avg_speed_mph avg_trip_duration_min avg_route_efficiency")

LTV = f"""
WITH m AS (
  SELECT c.customer_id, customer_type, count(ride_id) AS trips, sum(total_fare) AS value, avg(total_fare) AS fare,
    sum(tips) AS tips, date_diff('day', registration_date, DATE '2024-01-31') AS age
  FROM riders c JOIN completed r ON c.customer_id = r.customer_id GROUP BY c.customer_id, customer_type, registration_date)
SELECT customer_type, count(*) AS customer_count, avg(trips) AS avg_trips_per_customer, avg(value) AS avg_lifetime_value,
  avg(fare) AS avg_fare_per_trip, avg(tips) AS avg_total_tips, avg(value / nullif(age, 0) * 30) AS avg_monthly_value,
  quantile_cont(value, 0.5) AS median_lifetime_value
FROM m GROUP BY 1
"""
LTV_FLOATS = (
    "avg_trips_per_customer avg_lifetime_value avg_fare_per_trip avg_total_tips avg_monthly_value median_lifetime_value"
)
add("customer_ltv", lambda b: business.customer_ltv(b.riders, b.rides, b.rides_as_of), LTV, LTV_FLOATS)
add("customer_ltv_ranges", lambda b: business.customer_ltv(b.riders, b.rides, b.rides_as_of), LTV, LTV_FLOATS)

add("customer_churn", lambda b: business.customer_churn(b.riders, b.rides, LATER, days=30, idle_days=14), f"""
WITH a AS (
  SELECT c.customer_id, customer_type, max(pickup_datetime) AS last_ride, count(ride_id) AS n, sum(total_fare) AS revenue
  FROM riders c LEFT JOIN rides r ON c.customer_id = r.customer_id
    AND pickup_datetime >= TIMESTAMP '{LATER}' - INTERVAL 30 DAY
  GROUP BY 1, 2),
i AS (SELECT *, floor((epoch(TIMESTAMP '{LATER}') - epoch(last_ride)) / 86400) AS idle FROM a)
SELECT customer_type, count(*) FILTER (idle > 14) AS churned_customers, count(*) FILTER (idle <= 14) AS active_customers,
  count(*) AS total_customers, avg(n) AS avg_trips_per_customer, avg(revenue) AS avg_revenue_per_customer,
  round((100.0 * count(*) FILTER (idle > 14) / count(*))::DECIMAL(30,9), 2)::DOUBLE AS churn_rate
FROM i GROUP BY 1
""", "avg_trips_per_customer avg_revenue_per_customer")

add("ride_patterns", lambda b: business.ride_patterns(b.rides, b.riders), """
SELECT customer_type, CAST(hour(pickup_datetime) AS INT) AS hour,
  CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS trip_count,
  avg(total_fare) AS avg_fare, avg(trip_distance) AS avg_distance, avg(passenger_count) AS avg_passengers
FROM completed r JOIN riders c ON r.customer_id = c.customer_id GROUP BY 1, 2, 3
""", "avg_fare avg_distance avg_passengers")

add("daily_revenue", lambda b: business.daily_revenue(b.rides, b.rides_as_of), f"""
SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS total_trips, sum(total_fare) AS total_revenue,
  sum(base_fare) AS base_revenue, sum(distance_fare) AS distance_revenue, sum(time_fare) AS time_revenue,
  sum(tips) AS total_tips, sum(tolls) AS total_tolls, avg(surge_multiplier) AS avg_surge,
  sum(CASE WHEN surge_multiplier > 1 THEN (total_fare - tips - tolls) * (surge_multiplier - 1) / surge_multiplier ELSE 0 END)
    AS surge_revenue
FROM completed WHERE {RECENT} GROUP BY 1
""", "total_revenue base_revenue distance_revenue time_revenue total_tips total_tolls avg_surge surge_revenue")

add("revenue_by_service", lambda b: business.revenue_by_service(b.rides), """
SELECT service_type, count(*) AS trip_count, sum(total_fare) AS total_revenue, avg(total_fare) AS avg_fare,
  avg(trip_distance) AS avg_distance, avg(trip_duration / CAST(60 AS DOUBLE)) AS avg_duration_min, sum(tips) AS total_tips,
  avg(tips) AS avg_tips, round((100.0 * count(*) / sum(count(*)) OVER ())::DECIMAL(30,9), 2)::DOUBLE AS market_share_pct
FROM completed GROUP BY 1
""", "total_revenue avg_fare avg_distance avg_duration_min total_tips avg_tips")

add("zone_profitability", lambda b: business.zone_profitability(b.zones, b.rides), f"""
SELECT z.zone AS zone_name, z.area_type, count(ride_id) AS total_trips,
  round(sum(total_fare)::DECIMAL(30,9), 2)::DOUBLE AS total_revenue,
  round(avg(total_fare)::DECIMAL(30,9), 2)::DOUBLE AS avg_fare,
  round(avg(trip_distance)::DECIMAL(30,9), 2)::DOUBLE AS avg_distance,
  round((avg(wait_time) / 60)::DECIMAL(30,9), 2)::DOUBLE AS avg_wait_min,
  count(DISTINCT driver_id) AS unique_drivers, count(DISTINCT customer_id) AS unique_customers,
  round((sum(total_fare) / count(DISTINCT driver_id))::DECIMAL(30,9), 2)::DOUBLE AS revenue_per_driver,
  round((sum(total_fare) / count(DISTINCT customer_id))::DECIMAL(30,9), 2)::DOUBLE AS revenue_per_customer
FROM completed {NAMED} GROUP BY z.location_id, 1, 2
""")

add("ride_anomalies", lambda b: business.ride_anomalies(b.rides), """
WITH s AS (SELECT avg(total_fare) AS m1, stddev_samp(total_fare) AS s1, avg(trip_distance) AS m2,
    stddev_samp(trip_distance) AS s2 FROM completed),
x AS (SELECT *, (total_fare - m1) / nullif(s1, 0) AS z1, (trip_distance - m2) / nullif(s2, 0) AS z2 FROM completed CROSS JOIN s)
SELECT ride_id, driver_id, customer_id, pickup_datetime, total_fare, trip_distance,
  trip_duration / CAST(60 AS DOUBLE) AS duration_minutes, round(z1::DECIMAL(30,9), 2)::DOUBLE AS fare_zscore,
  round(z2::DECIMAL(30,9), 2)::DOUBLE AS distance_zscore,
  CASE WHEN abs(z1) > 3 THEN 'High Risk - Unusual Fare' WHEN abs(z2) > 3 THEN 'High Risk - Unusual Distance'
    WHEN trip_distance > 0 AND trip_duration < 60 THEN 'High Risk - Impossibly Fast'
    ELSE 'Medium Risk - High Fare per Mile' END AS anomaly_flag
FROM x WHERE abs(z1) > 3 OR abs(z2) > 3 OR (trip_distance > 0 AND trip_duration < 60)
  OR total_fare / nullif(trip_distance, 0) > 20
ORDER BY pickup_datetime DESC, ride_id LIMIT 100
""", "duration_minutes")

# --- live views at the reference time ---------------------------------------

NOON = "2024-01-20 12:00:00"

add("active_monitor", lambda b: demand.active_monitor(b.rides, NOON), f"""
SELECT count(*) FILTER (trip_status = 'InProgress') AS active_trips,
  count(DISTINCT CASE WHEN trip_status = 'InProgress' THEN driver_id END) AS active_drivers,
  count(*) FILTER (trip_status = 'Requested') AS pending_requests,
  avg(CASE WHEN trip_status = 'InProgress' THEN (epoch(TIMESTAMP '{NOON}') - epoch(pickup_datetime)) / 60 END)
    AS avg_trip_time_minutes
FROM rides WHERE pickup_datetime >= TIMESTAMP '{NOON}' - INTERVAL 4 HOUR
""", "avg_trip_time_minutes")

add("zone_heatmap", lambda b: demand.zone_heatmap(b.rides, b.zones, NOON), f"""
SELECT z.zone AS zone_name, latitude, longitude,
  count(CASE WHEN pickup_datetime >= TIMESTAMP '{NOON}' - INTERVAL 1 HOUR THEN 1 END) AS trips_last_hour,
  count(CASE WHEN pickup_datetime >= TIMESTAMP '{NOON}' - INTERVAL 15 MINUTE THEN 1 END) AS trips_last_15_min,
  avg(CASE WHEN pickup_datetime >= TIMESTAMP '{NOON}' - INTERVAL 1 HOUR THEN wait_time END) AS avg_wait_time,
  count(DISTINCT CASE WHEN pickup_datetime >= TIMESTAMP '{NOON}' - INTERVAL 1 HOUR THEN driver_id END) AS available_drivers
FROM zones z LEFT JOIN rides r ON z.location_id = r.pickup_zone_id GROUP BY z.location_id, 1, 2, 3
""", "latitude longitude avg_wait_time")
