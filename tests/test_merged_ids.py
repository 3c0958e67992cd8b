"""Distinct ids by bitmaps, constraint checks in one scan, spreads without cancellation."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabrank.operators import aggregates as a, joins, quality
from cabrank.plans import ride_business, ride_demand, trip_business, trip_demand
from conftest import plan_of, rows_of


def test_bitmaps_count_as_distinct_does(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), rnd.choice([None, rnd.randrange(9), rnd.randrange(-(10**6), 10**6), 2**40 + rnd.randrange(99)]), rnd.randrange(40), rnd.random()) for _ in range(4000)]
    df = spark.createDataFrame([*rows, ("none", None, 1, None)], "g string, i bigint, j int, x double").repartition(4)
    ids = {"is": "i", "js": "j"}
    cells = a.id_cells(df, ["g"], ["i", "j"], a.rows("_n"), *a.partial_sums("x"))
    found = a.merged_ids(cells, ["g"], ids, a.total("_n", "n"), a.merged_mean("x", "mean"))
    plain = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.countDistinct("i").alias("is"), F.countDistinct("j").alias("js"))
    for one, other in zip(sorted(rows_of(found), key=str), sorted(rows_of(plain), key=str)):
        assert one == {k: pytest.approx(v) for k, v in other.items()}
    whole = a.merged_ids(cells, [], ids, a.total("_n", "n"))  # groups are merged by uniting their bitmaps
    assert rows_of(whole) == [{"n": 4001, **{k: df.agg(F.countDistinct(c)).first()[0] for k, c in ids.items()}}]


def test_no_row_is_copied(bound):
    plans = [
        ride_business.zone_profitability(bound.zones, bound.rides),
        ride_demand.hour_zone_ratio(bound.rides, bound.zones),
        trip_demand.daily_performance(bound.trips),
    ]
    assert not any("Expand" in plan_of(p) for p in plans)


def test_constraints_read_the_rows_once(bound, spark, tmp_path):
    path = str(tmp_path / "rides")
    bound.rides.write.parquet(path)
    rides = spark.read.parquet(path)
    checks = quality.constraint_checks(
        rides, {"fare": "total_fare >= 0"}, ("pickup_datetime",), ("ride_id", "customer_id"), {"driver_id": (bound.drivers.filter("driver_id < 3"), "driver_id")}
    )
    plan = plan_of(checks)
    assert plan.count(f"{path}]") + plan.count(f"{path},") <= 1 and "Expand" not in plan and plan.count("driver_rating") == 0
    rows = {r["rule"]: r["breaches"] for r in rows_of(checks)}
    assert list(rows) and rows["foreign key: driver_id"] == rides.filter("driver_id >= 3").count()
    assert rows["unique: ride_id"] == rows["range: fare"] == rows["not null: pickup_datetime"] == 0
    assert rows["unique: customer_id"] == rides.groupBy("customer_id").count().filter("count > 1 AND customer_id IS NOT NULL").count()
    empty = {r["rule"]: r["breaches"] for r in rows_of(quality.constraint_checks(rides.limit(0), {"fare": "total_fare >= 0"}, (), ("ride_id",)))}
    assert empty == {"range: fare": 0, "unique: ride_id": 0}


def test_spread_of_large_fares(spark, make_rides):
    rng = np.random.default_rng(2)
    fares = 1e9 + rng.normal(0, 1, 400)
    start = dt.datetime(2024, 1, 1)
    rides = make_rides(*[{"total_fare": float(f), "pickup_datetime": start + dt.timedelta(minutes=17 * i)} for i, f in enumerate(fares)])
    weather = spark.createDataFrame([(1, start + dt.timedelta(hours=h), "Rain") for h in range(200)], "zone_id int, datetime timestamp, weather_condition string")
    row = rows_of(ride_demand.weather_impact(rides, weather))[0]
    assert row["total_trips"] == 400 and row["fare_stddev"] == pytest.approx(np.std(fares, ddof=1), rel=1e-6)


def test_long_code_lists_are_not_broadcast_unseen(spark, monkeypatch):
    df = spark.range(20).select((F.col("id") % 3).cast("string").alias("trip_type"), "id")
    stats = df.groupBy("trip_type").agg(F.max("id").alias("most"))
    expected = sorted(map(str, joins.stats_join_by_key(df, stats).collect()))
    hinted = lambda: "broadcast" in joins.stats_join_by_key(df, stats)._jdf.queryExecution().analyzed().toString()
    assert hinted()
    monkeypatch.setattr(joins, "MOST_CODES", 2)
    assert not hinted() and sorted(map(str, joins.stats_join_by_key(df, stats).collect())) == expected


def test_benchmarks_have_one_pass_for_both_counts(bound):
    row = rows_of(trip_business.benchmarks(bound.trips))[0]
    assert row["total_days"] == bound.trips.select("pickup_date").distinct().count()
