import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabrank.plans import ride_demand, trip_views
from cabrank.streaming import live, upsert
from conftest import RIDE_SCHEMA, rows_of


class Files:
    """A folder that a stream reads; every added frame is one file."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, df):
        df.select(*self.columns()).coalesce(1).write.mode("append").parquet(f"{self.path}/in")

    def columns(self):
        return self.spark.createDataFrame([], self.schema).columns

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in")

    def append(self, query):
        upsert.append_to_files(query, f"{self.path}/out", f"{self.path}/checkpoint")
        return self.spark.read.schema(query.schema).parquet(f"{self.path}/out")


@pytest.fixture
def ride_files(spark, tmp_path):
    return Files(spark, str(tmp_path), RIDE_SCHEMA)


def at(hour, minute=0, **more):
    start = dt.datetime(2024, 1, 10, hour, minute)
    return {"pickup_datetime": start, "dropoff_datetime": start + dt.timedelta(minutes=10), **more}


def test_hourly_windows_close_and_late_rows_are_dropped(ride_files, make_rides):
    ride_files.add(make_rides(at(8), at(8, 30, total_fare=40.0), at(9)))
    assert rows_of(ride_files.append(live.stream_tumbling_hourly(ride_files.stream()))) == []
    ride_files.add(make_rides(at(11)))
    first = ride_files.append(live.stream_tumbling_hourly(ride_files.stream()))
    assert sorted((r["hour"].hour, r["trip_count"], r["avg_fare"]) for r in rows_of(first)) == [(8, 2, 30.0), (9, 1, 20.0)]
    ride_files.add(make_rides(at(8, 59), at(13)))
    after = ride_files.append(live.stream_tumbling_hourly(ride_files.stream()))
    assert sorted((r["hour"].hour, r["trip_count"]) for r in rows_of(after)) == [(8, 2), (9, 1), (11, 1)]


def test_zone_demand_counts_the_last_quarter(ride_files, make_rides):
    ride_files.add(make_rides(at(8, 5), at(8, 50), at(8, 59, pickup_zone_id=2)))
    ride_files.add(make_rides(at(12)))
    rows = rows_of(ride_files.append(live.stream_zone_demand(ride_files.stream())))
    full = {r["pickup_zone_id"]: r for r in rows if r["window_end"] == dt.datetime(2024, 1, 10, 9)}
    assert (full[1]["trips_last_hour"], full[1]["trips_last_15_min"], full[1]["available_drivers"]) == (2, 1, 1)
    assert (full[2]["trips_last_hour"], full[2]["trips_last_15_min"]) == (1, 1)


def test_repeated_events_are_removed_across_files(spark, tmp_path):
    schema = "event_id bigint, ts timestamp"
    files = Files(spark, str(tmp_path), schema)
    moment = dt.datetime(2024, 1, 10, 8)
    files.add(spark.createDataFrame([(1, moment), (1, moment), (2, moment)], schema))
    files.add(spark.createDataFrame([(2, moment), (3, moment + dt.timedelta(hours=5))], schema))
    files.add(spark.createDataFrame([(5, moment + dt.timedelta(hours=5))], schema))
    files.add(spark.createDataFrame([(4, moment)], schema))  # behind the watermark by now
    kept = files.append(live.stream_dedup_late(files.stream()))
    assert sorted(r["event_id"] for r in rows_of(kept)) == [1, 2, 3, 5]


def test_shifts_are_split_by_the_gap(ride_files, make_rides):
    ride_files.add(make_rides(at(8), at(8, 25), at(9, 10), at(8, 10, driver_id=2)))
    ride_files.add(make_rides(at(15, driver_id=3)))
    rows = rows_of(ride_files.append(live.stream_sessions(ride_files.stream())))
    shifts = sorted((r["driver_id"], r["first_pickup"].hour, r["rides"], r["shift_revenue"]) for r in rows)
    assert shifts == [(1, 8, 2, 40.0), (1, 9, 1, 20.0), (2, 8, 1, 20.0)]


def test_daily_summary_follows_new_files_and_equals_the_batch(spark, curated, tmp_path):
    def day(d, **more):
        start = dt.datetime(2024, 3, d, 8)
        return {"pickup_datetime": start, "dropoff_datetime": start + dt.timedelta(minutes=20), **more}

    batches = [
        curated(day(1), day(1, trip_type="green", dropoff_location_id=3), day(2, payment_type=2)),
        curated(day(2, total_amount=75.0, pickup_location_id=3), day(5)),
    ]
    path, everything = str(tmp_path), None
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{path}/in")
        everything = batch if everything is None else everything.unionByName(batch)
        stream = spark.readStream.schema(batch.schema).parquet(f"{path}/in")
        upsert.stream_daily_upsert(stream, f"{path}/state", f"{path}/checkpoint")
        stored = {r["summary_date"]: r for r in rows_of(upsert.read_daily(spark, f"{path}/state"))}
        assert stored == {r["summary_date"]: r for r in rows_of(trip_views.trip_summary_daily(everything))}


def test_a_repeated_batch_changes_nothing(spark, curated, tmp_path, monkeypatch):
    """A batch that is run twice, as after a failure, replaces its own output."""
    captured = {}
    monkeypatch.setattr(upsert, "run_available", lambda writer, checkpoint: captured.setdefault("writer", writer))
    trips = curated({}, {})
    trips.coalesce(1).write.parquet(f"{tmp_path}/in")

    class Stream:
        @property
        def writeStream(self):
            return self

        def foreachBatch(self, function):
            captured["step"] = function

    upsert.stream_daily_upsert(Stream(), f"{tmp_path}/state", "unused")
    for batch_id in (0, 1, 1):
        captured["step"](trips, batch_id)
    assert rows_of(upsert.read_daily(spark, f"{tmp_path}/state"))[0]["total_trips"] == 4


def test_monitor_keeps_the_latest_status_and_forgets_old_rides(spark, ride_files, make_rides):
    ride_files.add(make_rides(at(8, trip_status="Requested"), at(8, trip_status="InProgress"), at(2, trip_status="Requested")))
    state = f"{ride_files.path}/state"
    upsert.stream_active_monitor(ride_files.stream(), state, f"{ride_files.path}/checkpoint")
    first = rows_of(upsert.read_monitor(spark, state))
    assert [(r["active_trips"], r["pending_requests"]) for r in first] == [(1, 1)]
    ride_files.add(make_rides(at(9, trip_status="InProgress"), at(9, trip_status="Completed")))
    upsert.stream_active_monitor(ride_files.stream(), state, f"{ride_files.path}/checkpoint")
    rows = sorted(rows_of(upsert.read_monitor(spark, state)), key=lambda r: r["version"])
    assert [(r["active_trips"], r["pending_requests"]) for r in rows] == [(1, 1), (1, 0)]


def test_stream_equals_batch_on_closed_hours(spark, ride_files, make_rides):
    rides = make_rides(*[at(h % 12, (h * 7) % 60, pickup_zone_id=h % 3, total_fare=float(h)) for h in range(60)])
    ride_files.add(rides)
    ride_files.add(make_rides(at(23)))
    streamed = ride_files.append(live.stream_tumbling_hourly(ride_files.stream()))
    batch = ride_demand.ride_hourly_demand_view(rides).select("hour", "pickup_zone_id", "trip_count", "avg_fare")
    key = ["hour", "pickup_zone_id"]
    assert rows_of(streamed.select(*batch.columns).orderBy(*key)) == rows_of(batch.orderBy(*key))


def test_latest_status_by_time(make_rides):
    rides = make_rides({"ride_id": 1, **at(8, trip_status="Requested")}, {"ride_id": 1, **at(9, trip_status="Completed")})
    assert [r["trip_status"] for r in rows_of(upsert.latest_status(rides).select("ride_id", F.col("trip_status")))] == ["Completed"]


STATES = ["Requested", "InProgress", "Completed"]


def test_latest_status_of_rides_that_keep_their_pickup_time(make_rides):
    for order in (STATES, STATES[::-1], ["InProgress", "Requested"]):
        rides = make_rides(*[{"ride_id": 1, **at(8, trip_status=s)} for s in order])
        assert [r["trip_status"] for r in rows_of(upsert.latest_status(rides))] == [max(order, key=STATES.index)]


def test_time_of_a_change_comes_before_progress(make_rides):
    rides = make_rides({"ride_id": 1, **at(8, trip_status="InProgress")}, {"ride_id": 1, **at(8, trip_status="Requested")})
    changes = rides.withColumn("updated_at", F.when(F.col("trip_status") == "Requested", 2).otherwise(1))
    latest = rows_of(upsert.latest_status(changes, changed="updated_at"))
    assert [(r["trip_status"], r["updated_at"]) for r in latest] == [("Requested", 2)]


def test_monitor_over_batches_out_of_order(spark, ride_files, make_rides):
    state = f"{ride_files.path}/state"
    for states in (["Completed", "Requested"], ["InProgress", "InProgress"]):
        ride_files.add(make_rides(*[{"ride_id": i, **at(8, trip_status=s)} for i, s in enumerate(states)]))
        upsert.stream_active_monitor(ride_files.stream(), state, f"{ride_files.path}/checkpoint")
    rows = sorted(rows_of(upsert.read_monitor(spark, state)), key=lambda r: r["version"])
    assert [(r["active_trips"], r["pending_requests"]) for r in rows] == [(0, 1), (1, 0)]


def test_zone_demand_counts_each_driver_once(spark, ride_files, make_rides):
    ride_files.add(make_rides(*[at(8, m, driver_id=d, wait_time=w) for m, d, w in ((0, 1, 10), (50, 1, 20), (55, 2, 60))], at(23)))
    rows = rows_of(ride_files.append(live.stream_zone_demand(ride_files.stream())))
    whole = [r for r in rows if (r["window_start"].hour, r["window_start"].minute) == (8, 0)]
    assert [(r["trips_last_hour"], r["trips_last_15_min"], r["avg_wait_time"], r["available_drivers"]) for r in whole] == [(3, 2, 30.0, 2)]
