import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bound(spark):
    from cabrank.sources.bindings import Bound

    return Bound(spark, SMALL)


TRIP = {
    "trip_key": 1,
    "trip_type": "yellow",
    "pickup_datetime": dt.datetime(2024, 3, 4, 8, 30),
    "dropoff_datetime": dt.datetime(2024, 3, 4, 9, 0),
    "pickup_location_id": 1,
    "dropoff_location_id": 2,
    "passenger_count": 1,
    "trip_distance": 5.0,
    "fare_amount": 20.0,
    "tip_amount": 4.0,
    "total_amount": 25.0,
    "payment_type": 1,
    "rate_code_id": 1,
}
TRIP_SCHEMA = (
    "trip_key bigint, trip_type string, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int, "
    "dropoff_location_id int, passenger_count int, trip_distance double, fare_amount double, tip_amount double, "
    "total_amount double, payment_type int, rate_code_id int"
)

RIDE = {
    "ride_id": 1,
    "driver_id": 1,
    "customer_id": 1,
    "pickup_datetime": dt.datetime(2024, 1, 10, 8, 0),
    "dropoff_datetime": dt.datetime(2024, 1, 10, 8, 20),
    "trip_duration": 1200,
    "pickup_zone_id": 1,
    "dropoff_zone_id": 2,
    "trip_distance": 5.0,
    "passenger_count": 1,
    "tips": 1.0,
    "tolls": 0.0,
    "surge_multiplier": 1.0,
    "total_fare": 20.0,
    "wait_time": 60,
    "route_efficiency": 1.0,
    "customer_rating": 5,
    "driver_rating": 5,
    "trip_status": "Completed",
    "service_type": "Standard",
}
RIDE_SCHEMA = (
    "ride_id bigint, driver_id bigint, customer_id bigint, pickup_datetime timestamp, dropoff_datetime timestamp, "
    "trip_duration bigint, pickup_zone_id bigint, dropoff_zone_id bigint, trip_distance double, passenger_count bigint, "
    "tips double, tolls double, surge_multiplier double, total_fare double, wait_time bigint, route_efficiency double, "
    "customer_rating bigint, driver_rating bigint, trip_status string, service_type string"
)


@pytest.fixture
def make_trips(spark):
    """Trips that differ from a plain valid trip only in the given fields."""

    def make(*changes):
        rows = [{**TRIP, "trip_key": i, **change} for i, change in enumerate(changes, start=1)]
        return spark.createDataFrame([tuple(r.values()) for r in rows], TRIP_SCHEMA)

    return make


@pytest.fixture
def make_rides(spark):
    def make(*changes):
        rows = [{**RIDE, "ride_id": i, **change} for i, change in enumerate(changes, start=1)]
        return spark.createDataFrame([tuple(r.values()) for r in rows], RIDE_SCHEMA)

    return make


@pytest.fixture
def make_zones(spark):
    def make(*rows):
        return spark.createDataFrame(
            list(rows), "location_id int, borough string, zone string, service_zone string"
        )

    return make


@pytest.fixture
def curated(make_trips):
    """Enriched and flagged trips."""
    from cabrank.operators import clean

    return lambda *changes: clean.curate(make_trips(*changes))


def rows_of(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
