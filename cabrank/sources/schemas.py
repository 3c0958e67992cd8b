"""Schemas of raw files, curated tables and ride-service tables."""

from __future__ import annotations


def schema(ddl: str) -> str:
    """A schema as a DDL string, which every Spark reader and ``createDataFrame`` accept."""
    return " ".join(ddl.split())


# Raw column names of the published trip files -> our names.
COMMON_COLUMNS = {
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "VendorID": "vendor_id",
    "congestion_surcharge": "congestion_surcharge",
}
RAW_COLUMNS = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        **COMMON_COLUMNS,
        "airport_fee": "airport_fee",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
        **COMMON_COLUMNS,
        "ehail_fee": "ehail_fee",
    },
}
ZONE_COLUMNS = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}

AMOUNTS = (
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "ehail_fee",
)
CODES = ("payment_type", "rate_code_id", "vendor_id")
REQUIRED = (
    "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
    "trip_distance", "fare_amount", "total_amount",
)

TYPES = {
    "pickup_datetime": "timestamp", "dropoff_datetime": "timestamp",
    "pickup_location_id": "int", "dropoff_location_id": "int", "passenger_count": "int",
    "payment_type": "int", "rate_code_id": "int", "vendor_id": "int", "store_and_fwd_flag": "string",
}


def raw_trips(kind: str) -> str:
    """Explicit schema of one raw trip file, for CSV reads without inference."""
    fields = [f"`{raw}` {TYPES.get(name, 'double')}" for raw, name in RAW_COLUMNS[kind].items()]
    return schema(", ".join(fields))


RAW_ZONES = schema("LocationID int, Borough string, Zone string, service_zone string")

ZONES = schema("location_id int, borough string, zone string, service_zone string, created_at timestamp")

CURATED_TRIPS = schema(
    """trip_id bigint, trip_type string, vendor_id int,
    pickup_datetime timestamp, pickup_location_id int, dropoff_datetime timestamp, dropoff_location_id int,
    passenger_count int, trip_distance double, rate_code_id int, store_and_fwd_flag string,
    fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double,
    improvement_surcharge double, congestion_surcharge double, airport_fee double, ehail_fee double,
    total_amount double, payment_type int,
    pickup_hour int, pickup_day_of_week int, pickup_month int, pickup_year int, pickup_date date, is_weekend boolean,
    trip_duration_minutes double, trip_speed_mph double, fare_per_mile double, tip_percentage double,
    is_valid_trip boolean, created_at timestamp"""
)
TRIP_PARTITIONS = ("pickup_year", "pickup_month")

TRIP_SUMMARY_DAILY = schema(
    """summary_date date, total_trips bigint, total_revenue double, avg_trip_distance double, avg_fare_amount double,
    avg_tip_amount double, avg_trip_duration double, unique_pickup_zones bigint, unique_dropoff_zones bigint,
    yellow_trips bigint, green_trips bigint, cash_trips bigint, card_trips bigint, updated_at timestamp"""
)
TRIP_SUMMARY_HOURLY = schema(
    """summary_date date, summary_hour int, trip_type string, pickup_borough string, total_trips bigint,
    total_revenue double, avg_trip_distance double, avg_fare_amount double, avg_tip_percentage double,
    avg_speed_mph double"""
)
MONTHLY_STATISTICS = schema(
    """pickup_year int, pickup_month int, trip_type string, total_trips bigint, total_revenue double, avg_fare double,
    avg_distance double, avg_tip_pct double, avg_duration double, unique_pickup_zones bigint,
    unique_dropoff_zones bigint, updated_at timestamp"""
)

# Ride-service model: name -> schema. The tables that the analyses over rides read.
RIDE_TABLES: dict[str, str] = {
    "zones": schema(
        """zone_id int not null, zone_name string not null, borough string, area_type string,
        latitude decimal(10,8), longitude decimal(11,8), avg_demand_score decimal(5,2)"""
    ),
    "drivers": schema(
        """driver_id int not null, driver_license string not null, first_name string not null,
        last_name string not null, email string, phone string, hire_date date not null, birth_date date,
        rating decimal(3,2), total_trips int, total_earnings decimal(12,2), status string, home_zone_id int,
        vehicle_id int"""
    ),
    "customers": schema(
        """customer_id int not null, first_name string, last_name string, email string not null, phone string,
        registration_date date not null, customer_type string, rating decimal(3,2), total_trips int,
        total_spent decimal(12,2), preferred_payment string, home_zone_id int, work_zone_id int, is_active boolean,
        last_trip_date date"""
    ),
    "rides": schema(
        """ride_id int not null, driver_id int, customer_id int, vehicle_id int, shift_id int,
        pickup_datetime timestamp not null, pickup_zone_id int, pickup_latitude decimal(10,8),
        pickup_longitude decimal(11,8), pickup_address string, dropoff_datetime timestamp, dropoff_zone_id int,
        dropoff_latitude decimal(10,8), dropoff_longitude decimal(11,8), dropoff_address string,
        trip_distance decimal(10,2), trip_duration int, passenger_count int, base_fare decimal(10,2),
        surge_multiplier decimal(3,2), distance_fare decimal(10,2), time_fare decimal(10,2), tips decimal(10,2),
        tolls decimal(10,2), misc_fees decimal(10,2), total_fare decimal(10,2), trip_status string,
        payment_status string, driver_rating int, customer_rating int, wait_time int, route_efficiency decimal(5,2),
        booking_type string, service_type string, device_type string"""
    ),
    "weather_data": schema(
        """weather_id int not null, zone_id int, datetime timestamp not null, temperature decimal(5,2),
        precipitation decimal(5,2), wind_speed decimal(5,2), visibility decimal(5,2), weather_condition string"""
    ),
}

# Every table the batch layer owns: name -> (schema, partition columns).
WAREHOUSE = {
    "trips": (CURATED_TRIPS, TRIP_PARTITIONS),
    "zones": (ZONES, ()),
    "trip_summary_daily": (TRIP_SUMMARY_DAILY, ()),
    "trip_summary_hourly": (TRIP_SUMMARY_HOURLY, ("summary_date",)),
    "monthly_statistics": (MONTHLY_STATISTICS, ("pickup_year",)),
}
