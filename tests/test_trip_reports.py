import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabrank.operators import quality
from cabrank.plans import trip_business as business
from cabrank.plans import trip_demand as demand
from cabrank.plans import trip_geography as geo
from cabrank.plans import trip_views as views
from conftest import rows_of

ZONES = [(1, "Queens", "JFK Airport", "Airports"), (2, "Queens", "LaGuardia", "Airports"), (3, "Bronx", "Park", "Boro Zone")]


def at(day, hour):
    return {"pickup_datetime": dt.datetime(2024, 3, day, hour), "dropoff_datetime": dt.datetime(2024, 3, day, hour, 30)}


def test_shares_add_up(bound):
    shares = rows_of(business.market_share(bound.trips))
    assert sum(r["trip_market_share_pct"] for r in shares) == pytest.approx(100, abs=0.02)
    assert sum(r["revenue_market_share_pct"] for r in shares) == pytest.approx(100, abs=0.02)
    per_type = {}
    for r in rows_of(business.payment_tips(bound.trips)):
        per_type[r["trip_type"]] = per_type.get(r["trip_type"], 0) + r["pct_of_type"]
    assert all(total == pytest.approx(100, abs=0.05) for total in per_type.values())


def test_counts_of_different_cuts_agree(bound):
    total = bound.trips.count()
    for report in (
        geo.borough_flows(bound.trips, bound.zones, min_trips=0), geo.airport_categories(bound.tz),
        demand.rush_hour_periods(bound.trips), views.trip_summary_hourly(bound.tz).withColumnRenamed("total_trips", "trip_count"),
        views.hourly_demand_type(bound.trips), business.rate_code_analysis(bound.trips),
    ):
        assert report.agg(F.sum("trip_count")).first()[0] == total


def test_airport_to_airport_counts_for_both_but_is_one_trip(curated, make_zones):
    trips, zones = curated({"pickup_location_id": 1, "dropoff_location_id": 2}), make_zones(*ZONES)
    both = {(r["airport_name"], r["trip_category"]) for r in rows_of(geo.airport_by_airport(trips, zones))}
    assert both == {("JFK Airport", "From Airport"), ("LaGuardia", "To Airport")}
    from cabrank.operators.joins import trips_with_zones

    once = rows_of(geo.airport_categories(trips_with_zones(trips, zones)))
    assert [(r["trip_category"], r["trip_count"]) for r in once] == [("From Airport", 1)]


def test_zero_spread_gives_no_outlier_and_no_error(curated):
    trips = curated({}, {}, {})
    assert rows_of(business.fare_zscore_by_type(trips)) == []
    assert rows_of(business.fare_anomaly_rules(trips)) == []


def test_outliers_are_labelled(curated):
    usual = [{"fare_amount": 20.0 + i % 3} for i in range(40)]
    trips = curated(*usual, {"fare_amount": 400.0}, {"fare_amount": 180.0})
    found = {r["trip_key"]: r["fare_classification"] for r in rows_of(business.fare_zscore_by_type(trips))}
    assert found == {41: "Anomaly", 42: "Outlier"}


def test_rules_are_tried_in_order_and_latest_come_first(curated):
    fast = {"pickup_datetime": dt.datetime(2024, 3, 5, 8), "dropoff_datetime": dt.datetime(2024, 3, 5, 8, 1)}
    trips = curated({}, {**fast, "trip_distance": 4.0, "fare_amount": 16.0}, *[{} for _ in range(20)], {"total_amount": 900.0})
    found = rows_of(business.fare_anomaly_rules(trips, k=5))
    assert [(r["trip_key"], r["anomaly_type"]) for r in found] == [(2, "Suspiciously Fast"), (23, "High Total Anomaly")]


def test_growth_needs_a_previous_month(curated):
    jan = {"pickup_datetime": dt.datetime(2024, 1, 9, 8), "dropoff_datetime": dt.datetime(2024, 1, 9, 9)}
    rows = rows_of(demand.monthly_growth(curated(jan, jan, {}, {}, {})).orderBy("pickup_month"))
    assert [(r["prev_month_trips"], r["month_over_month_growth_pct"]) for r in rows] == [(None, None), (2, 50.0)]


def test_surge_levels(curated):
    trips = curated(*[at(4, 8)] * 6, *[at(4, 9)] * 3, *[at(4, 10)] * 1, *[at(4, 11)] * 1, *[at(4, 12)] * 1)
    levels = {r["pickup_hour"]: (r["demand_level"], r["surge_multiplier"]) for r in rows_of(demand.peak_hours_surge(trips))}
    assert levels[8] == ("High Demand", 2.5) and levels[9] == ("Moderate Demand", 1.25)
    assert levels[10][0] == "Normal Demand"


def test_seven_day_average_starts_short(curated):
    trips = curated(*[at(1, 8)] * 2, *[at(2, 8)] * 4, *[at(9, 8)] * 3)
    rows = rows_of(demand.daily_7day_average(trips, n=2).orderBy("pickup_date"))
    assert [r["avg_7_day"] for r in rows] == [2.0, 3.0, 3.5]


def test_peaks_prefer_the_smaller_label_on_ties(curated):
    row = rows_of(demand.peak_indicators(curated(at(4, 9), at(4, 8), at(5, 8), at(5, 9))))[0]
    assert (row["peak_hour"], row["peak_hour_trips"], row["peak_day"], row["peak_day_trips"]) == (8, 2, "Monday", 2)


def test_weekdays_are_listed_from_monday(curated):
    names = [r["day_name"] for r in rows_of(demand.dow_patterns(curated(*[at(d, 8) for d in range(1, 8)])))]
    assert names == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_reports_on_no_trips(curated):
    none = curated({}).filter("trip_key < 0")
    summary = rows_of(business.exec_summary(none))[0]
    assert summary["total_trips"] == 0 and summary["avg_fare"] is None
    assert rows_of(business.market_share(none)) == []
    assert rows_of(business.exec_dashboard(none))[0]["total_trips"] is None
    assert rows_of(quality.ingestion_summary(none))[0]["valid_percentage"] is None


def test_ranks_are_independent(curated, make_zones):
    from cabrank.operators.joins import trips_with_zones

    trips = curated(
        {"pickup_location_id": 1, "trip_distance": 10.0, "fare_amount": 10.0, "total_amount": 5.0},
        {"pickup_location_id": 3, "trip_distance": 5.0, "fare_amount": 50.0, "total_amount": 99.0},
    )
    rows = {r["pickup_zone"]: r for r in rows_of(geo.zone_efficiency_ranks(trips_with_zones(trips, make_zones(*ZONES)), 1))}
    assert [rows["JFK Airport"][n] for n in ("speed_rank", "fare_rank", "revenue_rank")] == [1, 2, 2]
    assert [rows["Park"][n] for n in ("speed_rank", "fare_rank", "revenue_rank")] == [2, 1, 1]


def test_parameterised_functions(curated, make_zones):
    trips = curated(at(1, 8), at(2, 8), {**at(3, 8), "trip_type": "green", "pickup_location_id": 3})
    assert rows_of(business.get_trip_summary(trips, "2024-03-02", "2024-03-03"))[0]["total_trips"] == 2
    assert rows_of(business.get_trip_summary(trips, "2024-03-02", "2024-03-03", "green"))[0]["total_trips"] == 1
    top = rows_of(geo.get_top_pickup_zones(trips, make_zones(*ZONES), 5, start="2024-03-02"))
    assert [(r["zone_name"], r["trip_count"]) for r in top] == [("JFK Airport", 1), ("Park", 1)]


def test_quality_reports(curated, make_zones, make_trips):
    flagged = curated({}, {"passenger_count": None}, {"fare_amount": 0.0, "trip_type": "green"}, {"pickup_location_id": 77})
    summary = rows_of(quality.ingestion_summary(flagged))[0]
    assert (summary["valid_trips"], summary["invalid_trips"], summary["valid_percentage"]) == (2, 1, 50.0)
    assert rows_of(quality.retention_report(flagged))[0]["retention_pct"] == 50.0
    check = rows_of(quality.zone_reference_check(flagged, make_zones(*ZONES)))[0]
    assert (check["invalid_pickup_zones"], check["invalid_dropoff_zones"]) == (1, 0)
    nulls = {r["column_name"]: r["null_count"] for r in rows_of(quality.null_profile(flagged, ["passenger_count", "fare_amount"]))}
    assert nulls == {"passenger_count": 1, "fare_amount": 0}
    rules = quality.constraint_checks(
        flagged, ranges={"fare": "fare_amount > 0"}, not_null=("passenger_count",), unique=("trip_key", "trip_type"),
        foreign={"pickup_location_id": (make_zones(*ZONES), "location_id")},
    )
    assert {r["rule"]: r["breaches"] for r in rows_of(rules)} == {
        "range: fare": 1, "not null: passenger_count": 1, "unique: trip_key": 0, "unique: trip_type": 1,
        "foreign key: pickup_location_id": 1,
    }
    months = rows_of(quality.available_months(curated({}), F.lit("2024-05-20").cast("date")))
    assert [(r["data_year"], r["data_month"]) for r in months] == [(2024, m) for m in range(1, 6)]


def test_dated_reports_read_only_the_orders_of_their_days(spark, bound, monkeypatch):
    from cabrank.sources import storage
    from conftest import plan_of

    # Both passes of the percentiles run when the report is asked for, so their plans are looked at before that.
    plans, kept = [], storage.kept
    monkeypatch.setattr(storage, "kept", lambda df: (plans.append(plan_of(df)), kept(df))[1])
    business.payment_tips(bound.recent(30), bound.trips_as_of)
    pushed = [line for plan in plans for line in plan.split("\n") if "o_orderdate" in line and "PushedFilters" in line]
    assert len(plans) >= 2 and pushed and all("GreaterThanOrEqual(o_orderdate,2001-07-01" in line for line in pushed)
    recent = {r["trip_key"] for r in bound.recent(30).filter("pickup_date >= '2001-07-02'").collect()}
    assert recent == {r["trip_key"] for r in bound.trips.filter("pickup_date >= '2001-07-02'").collect()}


def test_distinct_counts_do_not_copy_rows(bound):
    from conftest import plan_of

    for report in (views.daily_trip_stats, views.monthly_statistics, views.trip_summary_daily, business.exec_summary, quality.dataset_overview):
        assert "Expand" not in plan_of(report(bound.trips))
