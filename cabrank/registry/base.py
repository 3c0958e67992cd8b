"""Registration of named queries together with the SQL they are compared with.

A query is a function of ``Bound`` (all input frames of one folder). Its SQL is
an independent statement over the same tables, run by another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cabrank.sources import bindings
from cabrank.sources.bindings import Bound

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The engines add in different orders, which moves the last bits of sums and
# means, so computed amounts are compared in steps that follow their magnitude;
# values beyond the last limit, infinities and NaN are compared as they are.
# Means often end in a 5 just behind the last place, where those bits would
# decide; the boundary between two steps is therefore not put at one half but
# at an irrational fraction, which no mean of a few short decimals comes near.
STEPS = (("1e4", "1e6"), ("1e9", "1e2"), ("1e14", "1e-3"))
OFFSET = "-1.180339887498949e-1"


def stepped(df: DataFrame, *names: str) -> DataFrame:
    """The named computed columns brought to the steps of the comparison; all others are left as they are."""

    def of(name: str) -> Column:
        value, size = F.col(name), F.abs(F.col(name))
        chain = F
        for limit, steps in STEPS:
            rounded = (F.round(value * float(steps) + float(OFFSET)) + 0.0) / float(steps)
            chain = chain.when(size < float(limit), rounded)
        return chain.otherwise(value).alias(name)

    return df.select(*[of(n) if n in names else F.col(n) for n in df.columns])


def stepped_sql(name: str) -> str:
    cases = " ".join(
        f"WHEN abs({name}) < {limit} THEN (round({name} * {steps} + {OFFSET}) + 0.0e0) / {steps}" for limit, steps in STEPS
    )
    return f"CASE {cases} ELSE {name} END AS {name}"


def add(name: str, run: Callable[[Bound], DataFrame], sql: str | None = None, floats: str = "") -> None:
    """Register a query; ``floats`` names the columns whose values depend on the order of additions."""
    computed = floats.split()
    QUERIES[name] = lambda spark, sf_dir: stepped(run(Bound(spark, sf_dir)), *computed)
    if sql is not None:
        replaced = ", ".join(map(stepped_sql, computed))
        chosen = f"* REPLACE ({replaced})" if replaced else "*"
        ORACLE[name] = f"WITH {COMMON}\nSELECT {chosen} FROM (\n{sql.strip()}\n)"


# --- common table expressions of the SQL side -------------------------------

SECONDS = "(epoch(dropoff_datetime) - epoch(pickup_datetime))"

TRIPS_ALL = f"""
SELECT *,
  CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
  CAST(dayofweek(pickup_datetime) + 1 AS INT) AS pickup_day_of_week,
  CAST(month(pickup_datetime) AS INT) AS pickup_month,
  CAST(year(pickup_datetime) AS INT) AS pickup_year,
  CAST(pickup_datetime AS DATE) AS pickup_date,
  dayofweek(pickup_datetime) IN (0, 6) AS is_weekend,
  {SECONDS} / CAST(60 AS DOUBLE) AS trip_duration_minutes,
  CASE WHEN {SECONDS} > 0 THEN trip_distance * CAST(3600 AS DOUBLE) / {SECONDS} END AS trip_speed_mph,
  CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
  CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * CAST(100 AS DOUBLE) ELSE 0 END AS tip_percentage,
  pickup_datetime < dropoff_datetime AND trip_distance > 0 AND trip_distance < 100 AND fare_amount > 0
    AND total_amount > 0 AND passenger_count > 0 AND passenger_count <= 6
    AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL AS is_valid_trip,
  CAST(0 AS DOUBLE) AS extra, CAST(0 AS DOUBLE) AS mta_tax, CAST(0 AS DOUBLE) AS improvement_surcharge,
  CAST(0 AS DOUBLE) AS congestion_surcharge, CAST(0 AS DOUBLE) AS airport_fee, CAST(0 AS DOUBLE) AS ehail_fee
FROM trips_raw WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
"""

TZ = """
SELECT t.*, p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
  d.borough AS dropoff_borough, d.zone AS dropoff_zone, d.service_zone AS dropoff_service_zone
FROM trips t LEFT JOIN zones p ON t.pickup_location_id = p.location_id
  LEFT JOIN zones d ON t.dropoff_location_id = d.location_id
"""


def _recent(days: int) -> str:
    return f"SELECT * FROM trips WHERE pickup_date >= DATE '{bindings.TRIPS_AS_OF}' - {days}"


PARTS = {
    **{name: text for name, (text, _) in bindings.VIEWS.items()},
    "trips_all": TRIPS_ALL,
    "trips": "SELECT * FROM trips_all WHERE is_valid_trip",
    "tz": TZ,
    "recent7": _recent(7),
    "recent30": _recent(30),
    "recent90": _recent(90),
    "completed": "SELECT * FROM rides WHERE trip_status = 'Completed'",
}
COMMON = ",\n".join(f"{name} AS (\n{text.strip()}\n)" for name, text in PARTS.items())

# --- labels of the SQL side -------------------------------------------------
# Code lists and report labels, written out again so that the SQL stays independent.

PAYMENT = """CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
  WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided Trip' ELSE 'Other' END"""
RATE = """CASE rate_code_id WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
  WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' ELSE 'Unknown' END"""
BAND = """CASE WHEN trip_distance <= 1 THEN '0-1 miles' WHEN trip_distance <= 2 THEN '1-2 miles'
  WHEN trip_distance <= 5 THEN '2-5 miles' WHEN trip_distance <= 10 THEN '5-10 miles'
  WHEN trip_distance <= 20 THEN '10-20 miles' ELSE '20+ miles' END"""
PART = """CASE WHEN pickup_hour IN (7, 8, 9) THEN 'Morning Rush' WHEN pickup_hour BETWEEN 10 AND 16 THEN 'Daytime'
  WHEN pickup_hour IN (17, 18, 19) THEN 'Evening Rush' WHEN pickup_hour >= 20 THEN 'Evening'
  ELSE 'Late Night/Early Morning' END"""
DAY = """CASE pickup_day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
  WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' ELSE 'Saturday' END"""
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
PERIOD = """avg(fare_amount) AS avg_fare, avg(trip_distance) AS avg_distance,
  avg(trip_duration_minutes) AS avg_duration, avg(trip_speed_mph) AS avg_speed, avg(tip_percentage) AS avg_tip_pct"""
# Computed columns of a trip.
DERIVED_FLOATS = "trip_duration_minutes trip_speed_mph fare_per_mile tip_percentage"
PERIOD_FLOATS = "avg_fare avg_distance avg_duration avg_speed avg_tip_pct"
