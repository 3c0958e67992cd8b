import datetime as dt
import math

from pyspark.sql import functions as F

from cabrank.operators import joins, sizing
from conftest import plan_of, rows_of

ZONES = [(1, "Queens", "JFK Airport", "Airports"), (2, "Queens", "LaGuardia", "Airports"), (3, "Bronx", "Park", "Boro Zone")]


def test_zones_are_left_joined_and_broadcast(curated, make_zones):
    trips = curated({"pickup_location_id": 1, "dropoff_location_id": 99}, {"pickup_location_id": 3, "dropoff_location_id": 2})
    zones = make_zones(*ZONES)
    tz = joins.trips_with_zones(trips, zones)
    rows = {r["trip_key"]: r for r in rows_of(tz)}
    assert rows[1]["pickup_zone"] == "JFK Airport" and rows[1]["dropoff_zone"] is None
    assert rows[2]["dropoff_borough"] == "Queens" and rows[2]["pickup_service_zone"] == "Boro Zone"
    assert rows_of(joins.inner_equi(trips, zones).select("trip_key")) == [{"trip_key": 2}]


def test_small_lookup_is_broadcast_and_large_one_is_not(bound):
    assert "BroadcastHashJoin" in plan_of(joins.add_zone(bound.trips, bound.zones, "pickup"))
    small = sizing.lookup(bound.zones)._jdf.queryExecution().analyzed().toString()
    large = sizing.lookup(bound.zones, limit=10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in small and "broadcast" not in large


def test_both_results_agree_without_broadcast(bound, monkeypatch):
    trips, zones = bound.trips.select("trip_key", "pickup_location_id", "total_amount"), bound.zones
    with_hint = joins.add_zone(trips, zones, "pickup").groupBy("pickup_zone").count()
    monkeypatch.setattr(joins, "lookup", lambda df: df.hint("merge"))
    without = joins.add_zone(trips, zones, "pickup").groupBy("pickup_zone").count()
    assert sorted(map(str, rows_of(with_hint))) == sorted(map(str, rows_of(without)))


def test_place_join_equals_or_join_without_nested_loop(curated, make_zones):
    trips = curated(
        {"pickup_location_id": 1, "dropoff_location_id": 3}, {"pickup_location_id": 3, "dropoff_location_id": 2},
        {"pickup_location_id": 1, "dropoff_location_id": 2}, {"pickup_location_id": 1, "dropoff_location_id": 1},
        {"pickup_location_id": 3, "dropoff_location_id": 3},
    )
    airports = make_zones(*ZONES[:2]).select("location_id", "zone")
    ours = joins.trips_at_locations(trips, airports)
    either = (F.col("pickup_location_id") == F.col("location_id")) | (F.col("dropoff_location_id") == F.col("location_id"))
    theirs = trips.join(airports, either)
    key = lambda df: sorted((r["trip_key"], r["location_id"]) for r in rows_of(df))
    assert key(ours) == key(theirs) == [(1, 1), (2, 2), (3, 1), (3, 2), (4, 1)]
    assert "NestedLoop" not in plan_of(ours) and "CartesianProduct" not in plan_of(ours)


def test_orphans_do_not_include_null_keys(spark, make_zones):
    fact = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, z int")
    zones = make_zones(*ZONES)
    assert [r["id"] for r in rows_of(joins.anti_semi_check(fact, "z", zones, "location_id"))] == [2]
    assert [r["id"] for r in rows_of(joins.matching_rows(fact, "z", zones, "location_id"))] == [1]


def test_left_join_conditions(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "k int, s string")
    kept = joins.left_outer(left, right, "k", F.col("s") == "a")
    assert sorted((r["k"], r["s"]) for r in rows_of(kept)) == [(1, "a"), (2, None)]
    inner = joins.left_then_filter(left, right, "k", F.col("s") == "a")
    assert rows_of(inner) == [{"k": 1, "s": "a"}]


def test_spread_only_touches_small_inputs(bound):
    orders = bound.table("orders")
    assert "Exchange" in plan_of(sizing.spread_small(orders, "o_orderkey"))
    unknown = bound.spark.createDataFrame([(1,)], "o_orderkey int")
    assert "Exchange" not in plan_of(sizing.spread_small(unknown, "o_orderkey"))
    assert sizing.output_tasks(orders) == sizing.output_tasks(unknown) == 4
    assert sizing.scanned_bytes(unknown) is None


def test_crowded_key_of_a_left_join_can_be_split(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (2, "again"), (1, "x")], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(500)] + [(3, 0), (None, 1), (2, 4)], "k int, r int")
    joined = joins.left_outer(left, right, "k")
    assert [r.k for r in joins.crowded_keys(right, "k").collect()] == [1]
    assert joined.columns == ["k", "l", "r"] and "_part" in plan_of(joined)
    assert sorted(map(str, joined.collect())) == sorted(map(str, left.join(right, "k", "left").collect()))


def test_left_join_where_one_driver_has_half_of_the_rides(bound):
    drivers = bound.drivers.select("driver_id", "first_name")
    busiest = drivers.agg(F.min("driver_id")).first()[0]
    rides = bound.rides.select("ride_id", "total_fare", F.when(F.col("ride_id") % 2 == 0, F.lit(busiest)).otherwise(F.col("driver_id")).alias("driver_id"))
    joined, plain = joins.left_outer(drivers, rides, "driver_id"), drivers.join(rides, "driver_id", "left")
    assert joined.columns == plain.columns and sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    plan = lambda df: plan_of(df).split("== Physical Plan ==")[-1].count("Scan parquet")
    assert plan(joined) == plan(plain) > 0  # each input is read once
    assert "CartesianProduct" not in plan_of(joined) and "NestedLoop" not in plan_of(joined)
    # No part of the crowded driver holds more than a task's share, or somewhat above as hashes vary.
    crowded = joins.crowded_keys(rides, "driver_id")
    share = rides.count() / sizing.output_tasks(rides)
    parts = math.ceil(rides.filter(F.col("driver_id") == busiest).count() / share)
    assert [(r.driver_id, r.parts) for r in crowded.collect()] == [(busiest, parts)] and parts >= 2
    part = F.pmod(F.xxhash64("ride_id", "total_fare", "driver_id"), F.col("parts"))
    sizes = [r["count"] for r in rides.join(crowded, "driver_id").groupBy(part).count().collect()]
    assert len(sizes) == parts and max(sizes) <= 1.3 * share


def test_left_join_without_crowded_keys_and_of_other_types(spark):
    left = spark.createDataFrame([(i, "l") for i in range(40)] + [(None, "n")], "k int, l string")
    right = spark.createDataFrame([(i, i) for i in range(20, 60)], "k int, r int")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert "_part" not in plan_of(joins.left_outer(left, right, "k"))
    assert same(joins.left_outer(left, right, "k"), left.join(right, "k", "left"))
    assert same(joins.left_outer(left, right.limit(0), "k"), left.join(right.limit(0), "k", "left"))
    assert joins.left_outer(left.limit(0), right, "k").collect() == []
    for kind in ("string", "date", "decimal(12,2)", "binary"):
        key = F.expr("date_add(DATE'2024-01-01', k)") if kind == "date" else F.col("k").cast("string").cast(kind)
        hot = right.unionAll(spark.createDataFrame([(25, -i) for i in range(200)], "k int, r int"))
        a, b = left.withColumn("k", key), hot.withColumn("k", key)
        assert same(joins.left_outer(a, b, "k"), a.join(b, "k", "left")), kind


def test_rows_of_the_same_hour_are_joined(spark):
    at = lambda text: dt.datetime.fromisoformat(f"2024-01-01 {text}")
    rides = spark.createDataFrame([(1, at("08:05"), "a"), (1, at("09:00"), "b"), (2, at("08:30"), "c")], "zone int, t timestamp, ride string")
    reports = spark.createDataFrame([(1, at("08:59"), "r"), (1, at("08:00"), "s"), (2, at("10:00"), "t")], "zone int, t timestamp, report string")
    names = lambda how: sorted(
        (r["ride"], r["report"] or "") for r in joins.time_bucket_join(rides, reports.withColumnRenamed("t", "u"), ["zone"], "t", "u", how).collect()
    )
    assert names("inner") == [("a", "r"), ("a", "s")]
    assert names("left") == [("a", "r"), ("a", "s"), ("b", ""), ("c", "")]


def test_crowded_hour_is_joined_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(joins, "CELL_ROWS", 20)
    at = lambda hour, i: dt.datetime(2024, 1, 1, hour, i % 60)
    # Crowded on both sides, on one side, on a side without matches, on neither; keys and times that are null; repeated rows.
    cells = {(1, 8): (90, 130), (1, 9): (50, 3), (2, 8): (2, 70), (2, 9): (45, 0), (3, 8): (0, 45), (3, 9): (4, 5)}
    rides = [(zone, at(hour, i), f"ride {zone} {hour} {i}") for (zone, hour), (n, _) in cells.items() for i in range(n)]
    reports = [(zone, at(hour, i), f"report {zone} {hour} {i}") for (zone, hour), (_, n) in cells.items() for i in range(n)]
    rides += [(None, at(8, i), f"nowhere {i}") for i in range(30)] + [(1, None, f"some time {i}") for i in range(30)] + rides[:5]
    reports += [(None, at(8, i), "nowhere") for i in range(30)] + [(1, None, "some time") for _ in range(30)] + reports[:5]
    left = spark.createDataFrame(rides, "zone int, t timestamp, ride string")
    right = spark.createDataFrame(reports, "zone bigint, u timestamp, report string")
    hour = lambda df, time: df.withColumn("h", F.date_trunc("hour", time))
    for how in ("inner", "left"):
        joined = joins.time_bucket_join(left, right, ["zone"], "t", "u", how)
        plain = hour(left, "t").join(hour(right, "u"), ["zone", "h"], how).drop("h")
        assert joined.schema == plain.schema and "_right_part" in plan_of(joined)
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect())), how
        few = joins.time_bucket_join(left, right.limit(0), ["zone"], "t", "u", how)
        assert few.count() == (len(rides) if how == "left" else 0)
    crowded = joins.crowded_cells(hour(left, "t"), hour(right, "u"), ["zone", "h"]).collect()
    assert sorted((r.zone, r.h.hour, r._left_parts or 1, r._right_parts or 1) for r in crowded) == [
        (1, 8, 5, 7), (1, 9, 3, 1), (2, 8, 1, 4), (2, 9, 3, 1), (3, 8, 1, 3)]


def test_hours_that_are_not_crowded_are_joined_as_they_are(bound):
    rides, reports = bound.rides.select("ride_id", "pickup_zone_id", "pickup_datetime"), bound.weather.withColumnRenamed("zone_id", "pickup_zone_id")
    plan = plan_of(joins.time_bucket_join(rides, reports, ["pickup_zone_id"], "pickup_datetime", "datetime", "left"))
    assert "_right_part" not in plan and "Generate" not in plan


def test_left_rows_that_meet_empty_parts_of_a_crowded_hour_stay_matched(spark, monkeypatch):
    monkeypatch.setattr(joins, "CELL_ROWS", 20)
    noon = dt.datetime(2024, 1, 1, 12)
    rides = spark.createDataFrame([(1, noon, "a"), (1, noon, "a"), (2, noon, "b")], "zone int, t timestamp, ride string")
    reports = spark.createDataFrame([(1, noon, "same")] * 100, "zone int, u timestamp, report string")  # all of them share a part
    joined = joins.time_bucket_join(rides, reports, ["zone"], "t", "u", "left")
    assert "_right_part" in plan_of(joined)
    counts = {(r.ride, r.report): r["count"] for r in joined.groupBy("ride", "report").count().collect()}
    assert counts == {("a", "same"): 200, ("b", None): 1}
