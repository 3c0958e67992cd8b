import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabrank.plans import ride_business as business
from cabrank.plans import ride_demand as demand
from cabrank.plans import ride_drivers as drivers
from conftest import rows_of

AS_OF = "2024-01-31 00:00:00"


def at(day, hour=8, minute=0):
    return {
        "pickup_datetime": dt.datetime(2024, 1, day, hour, minute),
        "dropoff_datetime": dt.datetime(2024, 1, day, hour, minute) + dt.timedelta(minutes=20),
    }


@pytest.fixture
def people(spark):
    rows = [(i, f"F{i}", "L", 4.5, "Inactive" if i == 9 else "Active", 1) for i in (1, 2, 3, 9)]
    return spark.createDataFrame(
        rows, "driver_id bigint, first_name string, last_name string, rating double, status string, home_zone_id int"
    )


@pytest.fixture
def riders(spark):
    rows = [(1, "A", dt.date(2023, 12, 2)), (2, "A", dt.date(2023, 1, 1)), (3, "B", dt.date(2023, 1, 1)), (4, "B", dt.date(2023, 1, 1))]
    return spark.createDataFrame(rows, "customer_id bigint, customer_type string, registration_date date")


@pytest.fixture
def ride_zones(spark):
    rows = [(1, "One", "Downtown", 40.0, -74.0), (2, "Two", "Suburban", 41.0, -73.0), (3, "Three", "Suburban", 42.0, -72.0)]
    return spark.createDataFrame(rows, "location_id int, zone string, area_type string, latitude double, longitude double")


def test_weather_repeats_rides_like_a_row_join_does(spark, make_rides):
    rides = make_rides(
        {**at(10), "total_fare": 10.0}, {**at(10, 8, 30), "total_fare": 30.0}, {**at(10, 9), "total_fare": 50.0},
        {**at(11), "total_fare": 70.0}, {**at(10), "trip_status": "Cancelled"}, {**at(10), "total_fare": None},
    )
    weather = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 10, 8, 5), 50.0, "Rain"), (1, dt.datetime(2024, 1, 10, 8, 50), 50.0, "Rain"),
         (1, dt.datetime(2024, 1, 10, 8, 55), 60.0, "Clear"), (1, dt.datetime(2024, 1, 10, 9, 5), 60.0, "Rain")],
        "zone_id bigint, datetime timestamp, temperature double, weather_condition string",
    )
    joined = rides.filter("trip_status = 'Completed'").join(
        weather,
        (F.col("pickup_zone_id") == F.col("zone_id"))
        & (F.date_trunc("hour", "pickup_datetime") == F.date_trunc("hour", "datetime")),
    )
    expected = {
        r["weather_condition"]: r
        for r in rows_of(joined.groupBy("weather_condition").agg(
            F.count("ride_id").alias("total_trips"), F.avg("total_fare").alias("avg_fare"),
            F.avg("wait_time").alias("avg_wait_time"), F.stddev_samp("total_fare").alias("fare_stddev")))
    }
    for row in rows_of(demand.weather_impact(rides, weather)):
        for name, value in expected[row["weather_condition"]].items():
            assert row[name] == (value if isinstance(value, str) else pytest.approx(value)), name
    warm = {r["temperature"]: r["trip_count"] for r in rows_of(demand.temperature_demand(rides, weather))}
    assert warm == {50.0: 8, 60.0: 5}
    contrast = rows_of(demand.weather_surge_contrast(demand.weather_impact(rides, weather)))
    assert contrast == [{"bad_weather_surge": 1.0, "clear_weather_surge": 1.0}]


def test_surge_advice_and_distinct_option(make_rides, ride_zones):
    rides = make_rides(*[{**at(10), "driver_id": 1}] * 7, *[{**at(10, 9), "driver_id": i} for i in (1, 2)])
    busy = rows_of(demand.surge_opportunities(rides, ride_zones, AS_OF, min_demand=1).orderBy("hour"))
    assert [(r["demand"], r["supply"], r["surge_recommendation"]) for r in busy] == [
        (7, 1, "High Surge Recommended"), (2, 2, "No Surge Needed"),
    ]
    twice = rides.unionByName(rides)
    same = rows_of(demand.surge_opportunities(twice, ride_zones, AS_OF, min_demand=1, unique_ids=False).orderBy("hour"))
    assert [r["demand"] for r in same] == [7, 2]


def test_zone_without_rides_stays_on_the_heatmap(make_rides, ride_zones):
    rides = make_rides(at(10, 7, 30), at(10, 7, 50), at(10, 6))
    rows = {r["zone_name"]: r for r in rows_of(demand.zone_heatmap(rides, ride_zones, "2024-01-10 08:00:00"))}
    assert (rows["One"]["trips_last_hour"], rows["One"]["trips_last_15_min"], rows["One"]["available_drivers"]) == (2, 1, 1)
    assert (rows["Two"]["trips_last_hour"], rows["Two"]["avg_wait_time"]) == (0, None)


def test_monitor_counts_by_status(make_rides):
    rides = make_rides(
        {**at(10, 7), "trip_status": "InProgress"}, {**at(10, 7), "trip_status": "InProgress"},
        {**at(10, 7), "trip_status": "Requested"}, {**at(10, 2), "trip_status": "InProgress"},
    )
    assert rows_of(demand.active_monitor(rides, "2024-01-10 08:00:00")) == [
        {"active_trips": 2, "active_drivers": 1, "pending_requests": 1, "avg_trip_time_minutes": 60.0}
    ]


def test_churn_counts_leave_out_customers_without_recent_rides(make_rides, riders):
    rides = make_rides({**at(25), "customer_id": 1}, {**at(5), "customer_id": 2}, {**at(25), "customer_id": 3})
    rows = {r["customer_type"]: r for r in rows_of(business.customer_churn(riders, rides, AS_OF, idle_days=20))}
    assert (rows["A"]["churned_customers"], rows["A"]["active_customers"], rows["A"]["churn_rate"]) == (1, 1, 50.0)
    assert (rows["B"]["churned_customers"], rows["B"]["active_customers"], rows["B"]["total_customers"]) == (0, 1, 2)
    assert rows["B"]["avg_trips_per_customer"] == 0.5 and rows["B"]["avg_revenue_per_customer"] == 20.0


def test_lifetime_value(make_rides, riders):
    rides = make_rides({**at(25), "customer_id": 1}, {**at(26), "customer_id": 1}, {**at(5), "customer_id": 2, "total_fare": 60.0})
    rows = rows_of(business.customer_ltv(riders, rides, AS_OF))
    assert len(rows) == 1 and rows[0]["customer_count"] == 2
    assert rows[0]["median_lifetime_value"] == 50.0
    assert rows[0]["avg_monthly_value"] == pytest.approx((40 / 60 * 30 + 60 / 395 * 30) / 2)


def test_driver_churn(make_rides, people):
    rides = make_rides({**at(30), "driver_id": 1}, {**at(20), "driver_id": 2}, {**at(10), "driver_id": 3}, {**at(30), "driver_id": 9})
    sql = {r["driver_id"]: r["churn_risk"] for r in rows_of(drivers.driver_churn_sql(people, rides, AS_OF))}
    assert sql == {1: "Low Risk", 2: "Medium Risk", 3: "High Risk"}
    levels = drivers.churn_levels(drivers.driver_metrics(people, rides), AS_OF)
    assert {r["driver_id"]: r["churn_risk"] for r in rows_of(levels)} == {1: "Active", 2: "Low Risk", 3: "Medium Risk", 9: "Active"}
    counts = {r["churn_risk"]: r["driver_count"] for r in rows_of(drivers.driver_churn_levels(levels))}
    assert counts == {"Active": 2, "Low Risk": 1, "Medium Risk": 1}
    at_risk = rows_of(drivers.churn_by_level_profile(levels).filter("churn_risk = 'Medium Risk'"))[0]
    assert (at_risk["at_risk_revenue"], at_risk["retained_value"]) == (20.0, 14.0)


def test_at_risk_performers_are_above_the_median(make_rides, people):
    rides = make_rides(
        {**at(5), "driver_id": 1, "total_fare": 90.0}, {**at(5), "driver_id": 2, "total_fare": 10.0}, {**at(30), "driver_id": 3}
    )
    levels = drivers.churn_levels(drivers.driver_metrics(people, rides), AS_OF)
    assert [r["driver_id"] for r in rows_of(drivers.at_risk_performers(levels))] == [1]


def test_utilization(make_rides, people):
    rides = make_rides(at(10, 8), at(10, 9), at(11, 8))
    row = rows_of(drivers.driver_utilization(people, rides, AS_OF))[0]
    assert (row["days_worked"], row["avg_trips_per_day"]) == (2, 1.5)
    assert row["utilization_rate"] == pytest.approx((2400 / 4800 + 1200 / 1200) / 2)
    instant = make_rides({"dropoff_datetime": dt.datetime(2024, 1, 10, 8, 0), "trip_duration": 36})
    assert rows_of(drivers.driver_utilization(people, instant, AS_OF))[0]["utilization_rate"] is None
    assert rows_of(drivers.driver_utilization_pct(instant))[0]["utilization_rate"] == pytest.approx(10.0)


def test_top_drivers_and_weekly(make_rides, people):
    rides = make_rides({**at(28), "driver_id": 1}, {**at(29), "driver_id": 2, "total_fare": 50.0}, {**at(29), "trip_status": "Cancelled"})
    top = rows_of(drivers.top_drivers(people, rides, AS_OF, k=1))
    assert [(r["driver_name"], r["total_revenue"]) for r in top] == [("F2 L", 50.0)]
    weeks = rows_of(drivers.weekly_performance(rides).orderBy("week_start"))
    assert [(r["week_start"], r["weekly_trips"]) for r in weeks] == [(dt.date(2024, 1, 22), 1), (dt.date(2024, 1, 29), 1)]


def test_routes_need_more_than_the_minimum(make_rides, ride_zones):
    rides = make_rides(*[{}] * 3, *[{"dropoff_zone_id": 3, "trip_distance": 0.0}] * 2)
    rows = rows_of(business.profitable_routes(rides, ride_zones, min_trips=1).orderBy("dropoff_zone"))
    assert [(r["dropoff_zone"], r["fare_per_mile"]) for r in rows] == [("Three", None), ("Two", 4.0)]
    assert len(rows_of(business.profitable_routes(rides, ride_zones, min_trips=2))) == 1


def test_patterns_equal_a_row_join(make_rides, riders):
    rides = make_rides({**at(13), "total_fare": 10.0}, {**at(13), "total_fare": 20.0, "customer_id": 2}, {**at(15), "customer_id": 3})
    rows = {(r["customer_type"], r["hour"], r["day_type"]): (r["trip_count"], r["avg_fare"]) for r in rows_of(business.ride_patterns(rides, riders))}
    assert rows == {("A", 8, "Weekend"): (2, 15.0), ("B", 8, "Weekday"): (1, 20.0)}


def test_anomaly_flags(make_rides):
    rides = make_rides(*[{"total_fare": 20.0 + i % 2} for i in range(30)], {"total_fare": 500.0}, {"trip_duration": 30},
                       {"trip_distance": 0.5})
    found = {r["ride_id"]: r["anomaly_flag"] for r in rows_of(business.ride_anomalies(rides))}
    assert found == {31: "High Risk - Unusual Fare", 32: "High Risk - Impossibly Fast",
                     33: "High Risk - Unusual Distance"}


def test_trend(make_rides):
    rides = make_rides(*[at(d) for d in range(1, 8)], *[at(d) for d in range(8, 15)] * 2)
    assert rows_of(demand.ride_wow_trend(rides)) == [{"last_avg": 2.0, "previous_avg": 1.0, "trend_pct": 100.0}]
    averages = rows_of(demand.ride_moving_average(rides).orderBy("trip_date"))
    assert averages[-1]["ma_7"] == 2.0 and averages[-1]["ma_14"] == 1.5


def test_uplift_of_nothing(make_rides, ride_zones):
    ratios = demand.hour_zone_ratio(make_rides({}), ride_zones)
    assert rows_of(demand.surge_uplift(ratios)) == [
        {"current_revenue": None, "potential_revenue": None, "revenue_increase_pct": None}
    ]
