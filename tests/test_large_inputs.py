"""Queries again in the way they run when no input counts as small: no broadcast of lookups, no map per group."""

import pytest

import __spark_entry__ as entry
from cabrank.operators import sizing
from conftest import SMALL, plan_of
from test_registry import ORACLE, QUERIES, duck, table  # noqa: F401

NAMES = (
    "hourly_demand_by_dow", "top_pickup_zones", "borough_flows", "airport_by_airport", "payment_tips",
    "speed_by_borough_hour", "route_efficiency", "benchmarks", "zone_reference_check", "fare_zscore_by_type",
    "hourly_zone_demand", "surge_opportunities", "weather_impact", "top_drivers", "at_risk_performers",
    "zone_popularity", "daily_trip_stats", "monthly_statistics", "left_outer", "time_bucket_join_left", "fare_percentiles",
    "fare_regression", "profitable_routes", "customer_ltv", "customer_churn", "ride_patterns", "zone_heatmap", "constraint_checks",
)


@pytest.fixture
def large(spark, monkeypatch):
    for limit in ("BROADCAST_LIMIT", "ROW_GROUP_BYTES"):
        monkeypatch.setattr(sizing, limit, 0)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        # Partitions count as skewed early, so skewed joins are split here too.
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_result_does_not_depend_on_the_size_of_the_input(large, duck, name):  # noqa: F811
    result = QUERIES[name](large, SMALL)
    expected = duck.sql(ORACLE[name])
    assert table(result.columns, result.collect()) == table(expected.columns, expected.fetchall())


def test_plans_have_no_nested_loop_over_two_tables(large):
    plan = plan_of(entry.queries()["airport_by_airport"](large, SMALL))
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
