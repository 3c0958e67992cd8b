import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabrank.functions import columns as c
from conftest import rows_of


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r["y"] for r in rows_of(df.orderBy("i").select(expression.alias("y")))]


def test_distance_bands_include_their_upper_bound(spark):
    miles = [0.5, 1.0, 1.01, 2.0, 2.01, 5.0, 5.01, 10.0, 10.01, 20.0, 20.01]
    bands = values(spark, "double", miles, c.distance_band("x"))
    assert bands == [
        "0-1 miles", "0-1 miles", "1-2 miles", "1-2 miles", "2-5 miles", "2-5 miles", "5-10 miles", "5-10 miles",
        "10-20 miles", "10-20 miles", "20+ miles",
    ]


def test_day_parts_cover_all_hours(spark):
    parts = values(spark, "int", list(range(24)), c.day_part("x"))
    assert parts[7:10] == ["Morning Rush"] * 3
    assert parts[10:17] == ["Daytime"] * 7
    assert parts[17:20] == ["Evening Rush"] * 3
    assert parts[20:] == ["Evening"] * 4
    assert parts[:7] == ["Late Night/Early Morning"] * 7


def test_weekend_evening_is_evening_and_other_weekend_hours_are_weekend(spark):
    weekend = values(spark, "int", [3, 8, 12, 18, 21], c.weekend_aware_day_part("x", F.lit(True)))
    assert weekend == ["Weekend", "Weekend", "Weekend", "Weekend", "Evening"]
    weekday = values(spark, "int", [3, 8, 12, 18, 21], c.weekend_aware_day_part("x", F.lit(False)))
    assert weekday == ["Late Night/Early Morning", "Morning Rush", "Daytime", "Evening Rush", "Evening"]


def test_code_labels(spark):
    assert values(spark, "int", [1, 6, 7, None], c.payment_method("x")) == ["Credit Card", "Voided Trip", "Other", "Other"]
    assert values(spark, "int", [2, 9], c.rate_type("x")) == ["JFK", "Unknown"]
    assert values(spark, "int", [1, 7, 8], c.day_name("x")) == ["Sunday", "Saturday", None]


def test_airport_names(spark):
    names = ["JFK Airport", "LaGuardia", "Newark Bay", "airport road", "EWR", "Midtown", None]
    assert values(spark, "string", names, c.is_airport("x")) == [True, True, True, False, False, False, None]
    assert values(spark, "string", names, c.is_airport("x", any_case=True))[:6] == [True, True, True, True, True, False]


def test_whole_days_are_24_hour_periods_not_midnights(spark):
    moments = [dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 0, 0), dt.datetime(2024, 1, 2, 1, 0)]
    as_of = c.moment("2024-01-03 00:00:00")
    assert values(spark, "timestamp", moments, c.whole_days_between("x", as_of)) == [1, 1, 0]
    later = [dt.datetime(2024, 1, 3, 1, 0)]
    assert values(spark, "timestamp", later, c.whole_days_between("x", as_of)) == [-1]


def test_ratios_without_a_denominator_are_null(spark):
    assert values(spark, "double", [0.0, 2.0, None], c.ratio(F.lit(1.0), "x")) == [None, 0.5, None]
    assert values(spark, "double", [0.0, -1.0, 10.0], c.calculate_tip_percentage(F.lit(2.0), F.col("x"))) == [0.0, 0.0, 20.0]
    assert values(spark, "double", [0.0, 1800.0], c.calculate_speed(F.lit(10.0), "x")) == [0.0, 20.0]


def test_rounding_is_half_up_without_binary_noise(spark):
    assert values(spark, "double", [2.675, 1.005, 9.574999999999999, -1.005, None], c.rounded("x", 2)) == [
        2.68, 1.01, 9.58, -1.01, None,
    ]


def test_surge_part_of_a_fare(spark):
    df = spark.createDataFrame(
        [(30.0, 3.0, 0.0, 1.5), (30.0, 3.0, 0.0, 1.0)], "total_fare double, tips double, tolls double, surge_multiplier double"
    )
    assert [r["s"] for r in rows_of(df.select(c.surge_revenue().alias("s")))] == [pytest.approx(9.0), 0.0]


def test_clip_keeps_null(spark):
    assert values(spark, "double", [0.5, 3.0, 9.0, None], c.clip("x", 1.0, 5.0)) == [1.0, 3.0, 5.0, None]


def test_text(spark):
    assert values(spark, "string", ["short", "a" * 25, "b" * 20], c.short_label("x")) == ["short", "a" * 20 + "...", "b" * 20]
    df = spark.createDataFrame([("A", "B"), ("A", None)], "first_name string, last_name string")
    assert [r["n"] for r in rows_of(df.select(c.full_name().alias("n")))] == ["A B", None]


def test_weekday_numbers(spark):
    sunday = [dt.datetime(2024, 3, 3, 5, 0)]
    assert values(spark, "timestamp", sunday, c.get_day_of_week("x")) == [6]
    assert values(spark, "timestamp", sunday + [None], c.get_hour("x")) == [5, None]


def test_sql_functions(spark, curated, make_zones):
    from cabrank.functions.sql import register_functions

    trips = curated({}, {"trip_type": "green"}, {"pickup_location_id": 2})
    trips.createOrReplaceTempView("trips")
    make_zones((1, "A", "One", "x"), (2, "B", "Two", "y")).createOrReplaceTempView("zones")
    register_functions(spark)
    one = rows_of(spark.sql("SELECT calculate_tip_percentage(2, 0) AS a, calculate_tip_percentage(2, 10) AS b, calculate_speed(10, 1800) AS c"))
    assert one == [{"a": 0.0, "b": 20.0, "c": 20.0}]
    yellow = rows_of(spark.sql("SELECT total_trips FROM get_trip_summary(DATE '2024-01-01', DATE '2024-12-31', 'yellow')"))
    assert yellow == [{"total_trips": 2}]
    assert rows_of(spark.sql("SELECT total_trips FROM get_trip_summary(DATE '2024-01-01', DATE '2024-12-31')")) == [{"total_trips": 3}]
    top = rows_of(spark.sql("SELECT zone_name, trip_count FROM get_top_pickup_zones(1)"))
    assert top == [{"zone_name": "One", "trip_count": 2}]
    spark.catalog.dropTempView("trips")
    spark.catalog.dropTempView("zones")
