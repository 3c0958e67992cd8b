import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabrank.operators import clean, setops
from cabrank.sources import schemas
from conftest import plan_of, rows_of


def flags(df):
    return [r["is_valid_trip"] for r in rows_of(clean.validity_flag(df).orderBy("trip_key"))]


def test_each_rule_can_fail(make_trips):
    start = dt.datetime(2024, 3, 4, 8, 30)
    df = make_trips(
        {}, {"dropoff_datetime": start}, {"trip_distance": 0.0}, {"trip_distance": 100.0}, {"fare_amount": 0.0},
        {"total_amount": -1.0}, {"passenger_count": 0}, {"passenger_count": 6}, {"passenger_count": 7},
        {"pickup_location_id": None}, {"dropoff_location_id": None},
    )
    assert flags(df) == [True, False, False, False, False, False, False, True, False, False, False]


def test_unknown_input_gives_unknown_flag_unless_another_rule_fails(make_trips):
    df = make_trips({"passenger_count": None}, {"passenger_count": None, "trip_distance": 0.0}, {"fare_amount": None})
    assert flags(df) == [None, False, None]
    assert clean.valid_trips(clean.validity_flag(df)).count() == 0


def test_loader_variant_counts_unknown_passengers_as_one(make_trips):
    df = make_trips({"passenger_count": None}, {"pickup_location_id": 0}, {"passenger_count": 0}, {})
    kept = rows_of(clean.valid_trips_loader(df).orderBy("trip_key"))
    assert [(r["trip_key"], r["passenger_count"]) for r in kept] == [(1, 1), (4, 1)]


def test_speed_variant_ignores_passengers(make_trips):
    df = clean.enrich_trips(make_trips({"passenger_count": None}, {"trip_distance": 60.0}, {"trip_distance": 0.4}))
    assert [r["trip_key"] for r in rows_of(clean.valid_trips_speed(df))] == [1]


def test_enriched_values(make_trips):
    row = rows_of(clean.enrich_trips(make_trips({})))[0]
    assert (row["pickup_hour"], row["pickup_day_of_week"], row["pickup_month"], row["pickup_year"]) == (8, 2, 3, 2024)
    assert row["pickup_date"] == dt.date(2024, 3, 4) and row["is_weekend"] is False
    assert (row["trip_duration_minutes"], row["trip_speed_mph"]) == (30.0, 10.0)
    assert (row["fare_per_mile"], row["tip_percentage"]) == (4.0, 20.0)


def test_undefined_measures_are_null_and_tip_is_zero(make_trips):
    start = dt.datetime(2024, 3, 4, 8, 30)
    df = make_trips({"dropoff_datetime": start, "trip_distance": 0.0, "fare_amount": 0.0})
    row = rows_of(clean.enrich_trips(df))[0]
    assert (row["trip_speed_mph"], row["fare_per_mile"], row["tip_percentage"]) == (None, None, 0.0)


def test_passengers_are_filled_only_on_request(make_trips):
    df = make_trips({"passenger_count": None, "payment_type": None, "tip_amount": None})
    row = rows_of(clean.fill_defaults(df))[0]
    assert (row["passenger_count"], row["payment_type"], row["tip_amount"], row["airport_fee"]) == (None, 1, 0.0, 0.0)
    assert rows_of(clean.fill_defaults(df, passengers=True))[0]["passenger_count"] == 1


def test_both_raw_dialects_become_one_layout(spark):
    yellow = spark.createDataFrame([(1, 2, 3.0, 0.5)], "PULocationID int, DOLocationID int, fare_amount double, Airport_fee double")
    green = spark.createDataFrame([(4, 5, 6.0, 0.25)], "PULocationID int, DOLocationID int, fare_amount double, ehail_fee double")
    both = setops.append_types(clean.standardize_trips(yellow, "yellow"), clean.standardize_trips(green, "green"))
    rows = {r["trip_type"]: r for r in rows_of(both)}
    assert rows["yellow"]["pickup_location_id"] == 1 and rows["yellow"]["airport_fee"] == 0.5
    assert rows["green"]["ehail_fee"] == 0.25 and rows["green"]["airport_fee"] == 0.0
    assert rows["green"]["passenger_count"] == 1 and rows["green"]["store_and_fwd_flag"] == "N"


def test_missing_columns_are_named(make_trips):
    with pytest.raises(ValueError, match="fare_amount, total_amount"):
        clean.require_columns(make_trips({}).drop("fare_amount", "total_amount"))


def test_zone_names_are_normalised(spark):
    raw = spark.createDataFrame([(1, None, "Z", None)], schemas.RAW_ZONES)
    assert rows_of(clean.normalize_zones(raw)) == [
        {"location_id": 1, "borough": "Unknown", "zone": "Z", "service_zone": "Unknown"}
    ]


def test_unions(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "x int, z int")
    assert setops.union_common(a, b).columns == ["x"]
    assert rows_of(setops.union_all_columns(a, b).orderBy("x")) == [
        {"x": 1, "y": 2, "z": None}, {"x": 3, "y": None, "z": 4},
    ]


def test_surrogate_key_numbers_all_rows_in_order_of_time(spark):
    base = dt.datetime(2024, 1, 1)
    # A third of the rows share one moment.
    moments = [base + dt.timedelta(hours=7 * i % 97) for i in range(200)] + [base] * 100
    df = spark.createDataFrame([(i, m) for i, m in enumerate(moments)], "k bigint, pickup_datetime timestamp")
    numbered = sorted(rows_of(clean.surrogate_key(df, ["k"], salts=4)), key=lambda r: r["trip_id"])
    assert [r["trip_id"] for r in numbered] == list(range(1, 301))
    times = [r["pickup_datetime"] for r in numbered]
    assert times == sorted(times)
    again = {r["k"]: r["trip_id"] for r in rows_of(clean.surrogate_key(df.repartition(7), ["k"], salts=4))}
    assert again == {r["k"]: r["trip_id"] for r in numbered}


def test_literal_reference_date_prunes_partitions(spark, curated, tmp_path):
    trips = curated({}, {"pickup_datetime": dt.datetime(2023, 1, 2, 8, 0), "dropoff_datetime": dt.datetime(2023, 1, 2, 9, 0)})
    trips.write.partitionBy("pickup_year", "pickup_month").parquet(str(tmp_path / "t"))
    recent = clean.since(spark.read.parquet(str(tmp_path / "t")), "2024-03-10", 30)
    assert [r["trip_key"] for r in rows_of(recent)] == [1]
    scan = next(line for line in plan_of(recent).splitlines() if "FileScan" in line)
    partition_filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "pickup_year" in partition_filters and "pickup_month" in partition_filters


def test_reference_date_bound_is_inclusive_across_years(curated):
    trips = curated(
        {"pickup_datetime": dt.datetime(2023, 12, 15, 1, 0), "dropoff_datetime": dt.datetime(2023, 12, 15, 2, 0)},
        {"pickup_datetime": dt.datetime(2023, 12, 14, 23, 0), "dropoff_datetime": dt.datetime(2023, 12, 15, 2, 0)},
        {"pickup_datetime": dt.datetime(2024, 1, 14, 23, 0), "dropoff_datetime": dt.datetime(2024, 1, 15, 2, 0)},
    )
    assert {r["trip_key"] for r in rows_of(clean.since(trips, "2024-01-14", 30))} == {1, 3}


def test_moment_filter(make_rides):
    rides = make_rides({}, {"pickup_datetime": dt.datetime(2024, 1, 10, 3, 59)})
    assert [r["ride_id"] for r in rows_of(clean.since_moment(rides, "2024-01-10 08:00:00", "4 hours"))] == [1]
    assert clean.since_moment(rides, F.lit("2024-01-10 08:00:00").cast("timestamp"), "5 hours").count() == 2
