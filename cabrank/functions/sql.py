"""The parameterised functions as SQL functions of the session.

They are SQL expressions, so Spark inlines and optimises them; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SCALAR_FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION calculate_tip_percentage(tip DOUBLE, fare DOUBLE) RETURNS DOUBLE
       RETURN CASE WHEN fare > 0 THEN tip / fare * 100 ELSE 0 END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION calculate_speed(miles DOUBLE, seconds DOUBLE) RETURNS DOUBLE
       RETURN CASE WHEN seconds > 0 THEN miles / (seconds / 3600) ELSE 0 END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION get_hour(ts TIMESTAMP) RETURNS INT RETURN hour(ts)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION get_day_of_week(ts TIMESTAMP) RETURNS INT RETURN weekday(ts)""",
)

# These read the session views ``trips`` (valid trips) and ``zones``.
TABLE_FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION get_trip_summary(
         from_date DATE, to_date DATE, only_type STRING DEFAULT NULL)
       RETURNS TABLE (total_trips BIGINT, total_revenue DOUBLE, avg_fare DOUBLE, avg_distance DOUBLE,
                      avg_duration DOUBLE, unique_zones BIGINT)
       RETURN SELECT count(*), sum(total_amount), avg(fare_amount), avg(trip_distance), avg(trip_duration_minutes),
                     count(DISTINCT pickup_location_id)
              FROM trips
              WHERE pickup_date BETWEEN from_date AND to_date AND (only_type IS NULL OR trip_type = only_type)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION get_top_pickup_zones(
         n INT DEFAULT 10, from_date DATE DEFAULT NULL, to_date DATE DEFAULT NULL)
       RETURNS TABLE (zone_name STRING, borough STRING, trip_count BIGINT, avg_fare DOUBLE, total_revenue DOUBLE)
       RETURN SELECT zone_name, borough, trip_count, avg_fare, total_revenue FROM (
                SELECT z.zone AS zone_name, z.borough AS borough, count(*) AS trip_count, avg(t.fare_amount) AS avg_fare,
                       sum(t.total_amount) AS total_revenue,
                       row_number() OVER (ORDER BY count(*) DESC, z.zone, z.borough) AS place
                FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id
                WHERE (from_date IS NULL OR t.pickup_date >= from_date)
                  AND (to_date IS NULL OR t.pickup_date <= to_date)
                GROUP BY z.zone, z.borough)
              WHERE place <= n""",
)


def register_functions(spark: SparkSession, tables: bool = True) -> None:
    """Create the functions; the table functions need the views ``trips`` and ``zones``."""
    for statement in SCALAR_FUNCTIONS + (TABLE_FUNCTIONS if tables else ()):
        spark.sql(statement)
