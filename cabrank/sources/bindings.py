"""Trip and ride views over the driver tables.

Each view is plain SQL that Spark and DuckDB both accept, so the same text
feeds the library (through ``spark.sql`` with DataFrame parameters) and the
comparison queries (as common table expressions). Fixed values: the formulas
are given with the test data.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabrank.operators import clean, joins
from cabrank.operators.sizing import fits_broadcast, spread_small
from cabrank.sources.storage import read_trips_parquet

ZONES = """
SELECT n_nationkey AS location_id, r_name AS borough,
  CASE WHEN n_nationkey % 8 = 3 THEN n_name || ' Airport' ELSE n_name END AS zone,
  CASE WHEN n_nationkey % 8 = 3 THEN 'Airports' WHEN n_regionkey = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone,
  CASE n_nationkey % 3 WHEN 0 THEN 'Downtown' WHEN 1 THEN 'Suburban' ELSE 'Industrial' END AS area_type,
  CAST(40 AS DOUBLE) + n_nationkey / CAST(100 AS DOUBLE) AS latitude,
  CAST(-74 AS DOUBLE) - n_nationkey / CAST(100 AS DOUBLE) AS longitude
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

TRIPS_RAW = """
SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS trip_key,
  CASE l_linestatus WHEN 'O' THEN 'yellow' ELSE 'green' END AS trip_type,
  CAST(l_suppkey % 2 + 1 AS INT) AS vendor_id,
  o_orderdate + ((l_orderkey * 37 + l_partkey * 13 + l_linenumber * 101) % 1440) * INTERVAL '1' MINUTE AS pickup_datetime,
  o_orderdate + ((l_orderkey * 37 + l_partkey * 13 + l_linenumber * 101) % 1440) * INTERVAL '1' MINUTE
    + (CAST(l_quantity AS BIGINT) * 150 + (l_partkey % 7) * 60 - 300) * INTERVAL '1' SECOND AS dropoff_datetime,
  s_nationkey AS pickup_location_id, c_nationkey AS dropoff_location_id,
  CAST(NULLIF(l_suppkey % 8, 7) AS INT) AS passenger_count,
  (l_quantity * (20 + (l_suppkey % 9) * 5)) / CAST(100 AS DOUBLE) AS trip_distance,
  l_linenumber AS rate_code_id,
  CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  l_extendedprice / CAST(1000 AS DOUBLE) AS fare_amount,
  (l_extendedprice / CAST(1000 AS DOUBLE)) * l_discount * CAST(3 AS DOUBLE) AS tip_amount,
  CASE WHEN l_linenumber = 7 THEN CAST(6.55 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
  l_extendedprice / CAST(1000 AS DOUBLE) + (l_extendedprice / CAST(1000 AS DOUBLE)) * l_discount * CAST(3 AS DOUBLE)
    + l_tax * CAST(10 AS DOUBLE) AS total_amount,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS payment_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
"""

RIDES = """
SELECT o_orderkey AS ride_id, o_orderkey % (SELECT count(*) FROM supplier) AS driver_id, o_custkey AS customer_id,
  TIMESTAMP '2024-01-01 00:00:00' + ((o_orderkey * 7919) % 43200) * INTERVAL '1' MINUTE AS pickup_datetime,
  TIMESTAMP '2024-01-01 00:00:00' + ((o_orderkey * 7919) % 43200) * INTERVAL '1' MINUTE
    + (30 + o_orderkey % 6900) * INTERVAL '1' SECOND AS dropoff_datetime,
  30 + o_orderkey % 6900 AS trip_duration,
  o_custkey % 25 AS pickup_zone_id, (o_custkey + o_orderkey) % 25 AS dropoff_zone_id,
  (o_orderkey % 400) / CAST(10 AS DOUBLE) AS trip_distance,
  1 + o_orderkey % 4 AS passenger_count,
  CAST(3.5 AS DOUBLE) AS base_fare,
  (o_orderkey % 400) / CAST(4 AS DOUBLE) AS distance_fare,
  (o_orderkey % 60) / CAST(2 AS DOUBLE) AS time_fare,
  (o_orderkey % 11) / CAST(2 AS DOUBLE) AS tips,
  CASE WHEN o_orderkey % 10 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(1.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS surge_multiplier,
  o_totalprice / CAST(1000 AS DOUBLE) AS total_fare,
  60 + o_orderkey % 540 AS wait_time,
  CAST(1 AS DOUBLE) + (o_orderkey % 50) / CAST(100 AS DOUBLE) AS route_efficiency,
  1 + o_orderkey % 5 AS driver_rating, 1 + (o_orderkey + o_custkey) % 5 AS customer_rating,
  CASE o_orderstatus WHEN 'F' THEN 'Standard' WHEN 'O' THEN 'Premium' ELSE 'Pool' END AS service_type,
  CASE o_orderkey % 20 WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'InProgress' WHEN 2 THEN 'Requested' ELSE 'Completed' END AS trip_status
FROM orders
"""

DRIVERS = """
SELECT s_suppkey AS driver_id, s_name AS first_name, 'D' AS last_name, s_acctbal / CAST(2000 AS DOUBLE) AS rating,
  CASE WHEN s_suppkey % 10 = 0 THEN 'Inactive' ELSE 'Active' END AS status, s_nationkey AS home_zone_id
FROM supplier
"""

RIDERS = """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type, c_nationkey AS home_zone_id,
  c_custkey % 10 <> 0 AS is_active, DATE '2023-01-01' + CAST(c_custkey % 300 AS INT) AS registration_date
FROM customer
"""

WEATHER = """
SELECT event_id AS weather_id, user_id % 25 AS zone_id, ts AS datetime, value AS temperature,
  CASE event_type WHEN 'signup' THEN 'Clear' WHEN 'view' THEN 'Cloudy' WHEN 'click' THEN 'Rain'
    WHEN 'purchase' THEN 'Snow' ELSE 'Fog' END AS weather_condition
FROM events
"""

# The same joins in another order, for tables too large to broadcast: orders meet
# their customers first, so rows as many as the lines are moved for two joins and
# not for three.
IN_LINE_ORDER = TRIPS_RAW[TRIPS_RAW.index("FROM lineitem"):]
CUSTOMERS_FIRST = """FROM lineitem JOIN (orders JOIN customer ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
"""

VIEWS = {
    "zones": (ZONES, ("nation", "region")),
    "trips_raw": (TRIPS_RAW, ("lineitem", "orders", "supplier", "customer")),
    "rides": (RIDES, ("orders", "supplier")),
    "drivers": (DRIVERS, ("supplier",)),
    "riders": (RIDERS, ("customer",)),
    "weather": (WEATHER, ("events",)),
}

# Schemas of the source tables; with them no footer has to be read to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# The table that gives a view its rows, with a key to spread it by.
FACT_KEYS = {("trips_raw", "lineitem"): "l_orderkey", ("rides", "orders"): "o_orderkey", ("weather", "events"): "event_id"}

# Rides and weather are read as of this moment, trips as of this day, instead of the clock.
RIDES_AS_OF = "2024-01-31 00:00:00"
TRIPS_AS_OF = "2001-08-01"


def view(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One view over the given source tables, without registering any name."""
    text, sources = VIEWS[name]
    if name == "trips_raw" and not fits_broadcast(tables["orders"], tables["customer"]):
        text = text.replace(IN_LINE_ORDER, CUSTOMERS_FIRST)
    prefix = ", ".join(f"{s} AS (SELECT * FROM {{{s}}})" for s in sources)
    return spark.sql(f"WITH {prefix} {text}", **{s: tables[s] for s in sources})


class Bound:
    """All input frames of the library for one folder of driver tables. Everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_trips_parquet(self.spark, f"{self.sf_dir}/{name}.parquet", schema=TABLES[name])

    def _source(self, name: str, of_view: str) -> DataFrame:
        """A source table of a view; the table whose rows the view lists is spread when it is small."""
        key = FACT_KEYS.get((of_view, name))
        return spread_small(self.table(name), key) if key else self.table(name)

    def _view(self, name: str) -> DataFrame:
        return view(self.spark, name, {s: self._source(s, name) for s in VIEWS[name][1]})

    @cached_property
    def zones(self) -> DataFrame:
        return self._view("zones")

    @cached_property
    def trips_raw(self) -> DataFrame:
        return self._view("trips_raw")

    @cached_property
    def rides(self) -> DataFrame:
        return self._view("rides")

    @cached_property
    def drivers(self) -> DataFrame:
        return self._view("drivers")

    @cached_property
    def riders(self) -> DataFrame:
        return self._view("riders")

    @cached_property
    def weather(self) -> DataFrame:
        return self._view("weather")

    @cached_property
    def trips_all(self) -> DataFrame:
        """Enriched trips with the validity flag, valid or not."""
        return clean.fill_defaults(clean.validity_flag(clean.enrich_trips(clean.drop_null_times(self.trips_raw))))

    @cached_property
    def trips(self) -> DataFrame:
        return clean.valid_trips(self.trips_all)

    @cached_property
    def tz(self) -> DataFrame:
        return joins.trips_with_zones(self.trips, self.zones)

    @cached_property
    def completed(self) -> DataFrame:
        return clean.completed_rides(self.rides)

    def recent(self, days: int) -> DataFrame:
        """Valid trips that may have begun at most ``days`` before the reference date, from a scan of their orders only.

        A trip begins less than a day after the time of its order.
        """
        first = dt.datetime.fromisoformat(TRIPS_AS_OF) - dt.timedelta(days=days + 1)
        sources = {s: self._source(s, "trips_raw") for s in VIEWS["trips_raw"][1]}
        sources["orders"] = sources["orders"].filter(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
        return clean.valid_trips(clean.curate(view(self.spark, "trips_raw", sources)))

    @property
    def trips_as_of(self) -> str:
        return TRIPS_AS_OF

    @property
    def rides_as_of(self) -> str:
        return RIDES_AS_OF
