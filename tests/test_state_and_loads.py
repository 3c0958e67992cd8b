"""Verified loads, rejected lines, compaction, state by buckets, segments that repeat."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cabrank.operators import ml
from cabrank.plans import ride_drivers, trip_views
from cabrank.sources import storage
from cabrank.streaming import upsert
from conftest import rows_of


def test_broken_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,name,x\n1,a,1.5\n2,b,oops\n3,c\n4,d,2.5,9\n5,,\nz,e,1.0\n")
    accepted, rejected = storage.read_csv_checked(spark, str(tmp_path / "in.csv"), "id int, name string, x double")
    assert sorted(map(tuple, accepted.collect())) == [(1, "a", 1.5), (5, None, None)]
    assert accepted.select("id").count() == 2
    assert sorted(r[storage.BROKEN] for r in rejected.collect()) == ["2,b,oops", "3,c", "4,d,2.5,9", "z,e,1.0"]


def load(spark, path, n=200):
    df = spark.range(n).select("id", (F.col("id") % 7).cast("string").alias("s"), F.when(F.col("id") % 3 > 0, F.col("id") / 2).alias("x"))
    return df, storage.load_verified(df, path, 4)


@pytest.mark.parametrize("fault", ["changed", "lost", "doubled"])
def test_a_load_finds_and_mends_wrong_batches(spark, tmp_path, fault):
    path = str(tmp_path)
    df, report = load(spark, path)
    assert report.count() == 4 and report.filter("NOT verified").isEmpty()
    batch = report.orderBy("batch").first().batch
    rows = spark.read.parquet(f"{path}/rows/batch={batch}").collect()
    frame = spark.createDataFrame(
        {"changed": [(*rows[0][:2], -1.0), *rows[1:]], "lost": rows[1:], "doubled": [*rows, rows[0]]}[fault], df.schema
    )
    frame.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    wrong = storage.verify_load(spark, path, df.schema).filter("NOT verified").collect()
    assert [r.batch for r in wrong] == [batch] and wrong[0].loaded_rows == len(rows) + {"changed": 0, "lost": -1, "doubled": 1}[fault]
    others = {p: p.stat().st_mtime_ns for p in Path(path).glob("rows/batch=*/*.parquet") if f"batch={batch}/" not in str(p)}
    _, again = load(spark, path)
    assert again.filter("NOT verified").isEmpty() and all(p.stat().st_mtime_ns == t for p, t in others.items())
    assert sorted(map(str, storage.loaded_rows(spark, path, df.schema).select(*df.columns).collect())) == sorted(map(str, df.collect()))


def test_sample_reads_only_the_first_files(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, None if i < 3 else start + dt.timedelta(minutes=i // 5)) for i in range(4000)], "id bigint, pickup_datetime timestamp").repartition(5)
    storage.write_combined_sample(df, str(tmp_path / "all"), str(tmp_path / "csv"), rows=50)
    written = spark.read.parquet(str(tmp_path / "all"))
    files = storage.files_with_first(written, 50)
    assert 0 < len(files) < len(written.inputFiles())
    sample = storage.read_csv_header(spark, str(tmp_path / "csv"), "id bigint, pickup_datetime timestamp")
    assert sorted(r.id for r in sample.collect()) == list(range(50))
    assert len(storage.files_with_first(written, 10**6)) == len(written.inputFiles())
    storage.write_combined_sample(df.limit(0), str(tmp_path / "none"), str(tmp_path / "csv0"))


class Steps:
    """Stands for a stream whose batches are run by hand."""

    def __init__(self, monkeypatch):
        monkeypatch.setattr(upsert, "run_available", lambda writer, checkpoint: None)

    @property
    def writeStream(self):
        return self

    def foreachBatch(self, function):
        self.step = function


def test_partial_results_are_compacted(spark, curated, tmp_path, monkeypatch):
    path, stream = str(tmp_path / "state"), Steps(monkeypatch)
    upsert.stream_daily_upsert(stream, path, "unused", compact_after=3)
    everything = None
    for n in range(8):
        start = dt.datetime(2024, 3 if n != 4 else 4, 1 + n % 3, 8)
        batch = curated({"pickup_datetime": start, "dropoff_datetime": start + dt.timedelta(minutes=20), "total_amount": 10.0 + n})
        everything = batch if everything is None else everything.unionByName(batch)
        stream.step(batch, n)
        stored = {r["summary_date"]: r for r in rows_of(upsert.read_daily(spark, path))}
        assert stored == {r["summary_date"]: r for r in rows_of(trip_views.trip_summary_daily(everything))}
        if n in (2, 3, 6):  # repeated right after a compaction, after a step without one, and later
            stream.step(batch, n)
            assert {r["summary_date"]: r for r in rows_of(upsert.read_daily(spark, path))} == stored
    bases = upsert.base_batches(spark, path, ["2024-03", "2024-04"])
    assert bases == {"2024-03": 6, "2024-04": -1}
    read = upsert.partial_results(spark, path, bases)
    # Two files at most: the base and the one batch after it.
    assert read.filter("month = '2024-03'").select(F.col("_metadata.file_path") if False else F.input_file_name()).distinct().count() <= 3


def at(hour, ride, status, minute=0):
    start = dt.datetime(2024, 1, 10, hour, minute)
    return {"ride_id": ride, "pickup_datetime": start, "dropoff_datetime": start + dt.timedelta(minutes=20), "trip_status": status}


def test_a_small_batch_rewrites_only_its_buckets(spark, make_rides, tmp_path, monkeypatch):
    path, stream = str(tmp_path / "state"), Steps(monkeypatch)
    upsert.stream_active_monitor(stream, path, "unused", buckets=8)
    stream.step(make_rides(*[at(8, i, "InProgress") for i in range(40)]), 0)
    stream.step(make_rides(at(9, 1, "Completed"), at(9, 100, "Requested")), 1)
    listed = lambda v: spark.read.parquet(f"{path}/versions/version={v}").count()
    written = {str(p.parent.name): p.parent.parent.name for p in Path(path).glob("state/bucket=*/version=1/*.parquet")}
    assert listed(0) == 8 and listed(1) <= 2 and len(set(written.values())) <= 2
    monitor = lambda: [(r["version"], r["active_trips"], r["pending_requests"]) for r in sorted(rows_of(upsert.read_monitor(spark, path)), key=lambda r: r["version"])]
    assert monitor() == [(0, 40, 0), (1, 39, 1)]
    # The batch again, as after a failure; then one that lets all early rides expire, and an empty one.
    stream.step(make_rides(at(9, 1, "Completed"), at(9, 100, "Requested")), 1)
    assert monitor() == [(0, 40, 0), (1, 39, 1)]
    stream.step(make_rides(at(13, 200, "InProgress", 30)), 2)
    stream.step(make_rides(at(13, 200, "InProgress")).limit(0), 3)
    assert monitor()[2:] == [(2, 1, 0), (3, 1, 0)]


def test_segments_do_not_depend_on_partitions(bound, spark):
    metrics = ride_drivers.driver_metrics(bound.drivers, bound.rides)
    results = [sorted((r.driver_id, r.cluster) for r in ml.driver_segments(m).collect()) for m in (metrics.coalesce(1), metrics.repartition(8))]
    assert results[0] == results[1] and {c for _, c in results[0]} == {0, 1, 2, 3}
    assert ml.driver_segments(metrics.limit(0)).collect() == []
    same = metrics.withColumns({n: F.lit(1.0) for n in ml.SEGMENT_FEATURES})
    assert {r.cluster for r in ml.driver_segments(same).collect()} == {0}
