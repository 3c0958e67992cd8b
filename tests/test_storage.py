import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cabrank.operators import ordering
from cabrank.sources import schemas, storage
from conftest import rows_of


class Named:
    """Stands for a session of a cluster."""

    def __init__(self, folder, master="spark://host:7077"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_is_the_one_the_session_names(spark):
    assert storage.scratch_path(Named("hdfs://shared/"), "x").startswith("hdfs://shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.scratch_path(Named(None), "x")
    assert storage.scratch_path(Named(None, "local[2]"), "x").startswith("/")
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")


def test_csv_keeps_types_without_inference(spark, tmp_path):
    raw = spark.createDataFrame([(1, "Queens", "JFK", None)], schemas.RAW_ZONES)
    raw.write.option("header", True).csv(str(tmp_path / "z"))
    assert rows_of(storage.read_csv_header(spark, str(tmp_path / "z"), schemas.RAW_ZONES)) == rows_of(raw)


def test_first_existing_table_is_read(spark):
    name = f"v_{uuid.uuid4().hex}"
    spark.range(3).createOrReplaceTempView(name)
    assert storage.read_table(spark, ["missing_one", name], "id bigint").count() == 3
    empty = storage.read_table(spark, ["missing_one"], schemas.CURATED_TRIPS)
    assert empty.count() == 0 and len(empty.columns) == 34
    spark.catalog.dropTempView(name)


def test_every_schema_can_be_created(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    storage.create_database(spark, database, str(tmp_path))
    names = storage.create_tables(spark, database, str(tmp_path))
    rides = f"{database}_rides"
    storage.create_database(spark, rides, str(tmp_path / "rides"))
    names += storage.create_ride_tables(spark, rides, str(tmp_path / "rides"))
    assert len(names) == len(schemas.WAREHOUSE) + len(schemas.RIDE_TABLES)
    assert all(spark.table(name).count() == 0 for name in names)
    storage.refresh_statistics(spark, names[0])
    for name in (database, rides):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_overwrite_replaces_only_the_given_partitions(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    storage.create_database(spark, database, str(tmp_path))
    storage.create_tables(spark, database, str(tmp_path))
    table = f"{database}.monthly_statistics"

    def row(year, trips):
        values = {f.name: None for f in spark.table(table).schema}
        values.update(pickup_year=year, pickup_month=1, trip_type="yellow", total_trips=trips)
        return spark.createDataFrame([tuple(values.values())], schema=spark.table(table).schema)

    storage.overwrite_table(row(2023, 1).unionByName(row(2024, 2)), table)
    storage.overwrite_table(row(2024, 5), table)
    storage.append_table(row(2024, 7), table)
    assert sorted((r["pickup_year"], r["total_trips"]) for r in rows_of(spark.table(table))) == [(2023, 1), (2024, 5), (2024, 7)]
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_partitioned_write_keeps_all_rows(spark, tmp_path):
    df = spark.range(1000).withColumn("kind", F.when(F.col("id") % 3 > 0, "hot").otherwise("cold"))
    storage.write_partitioned(df, str(tmp_path / "p"), by="kind")
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {r["kind"]: r["count"] for r in rows_of(back.groupBy("kind").count())} == {"hot": 666, "cold": 334}
    storage.write_partitioned(df.limit(1), str(tmp_path / "p"), mode="append", by=["kind"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1001


def test_layout_files_hold_disjoint_periods(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=(i * 37) % 1000)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, pickup_datetime timestamp")
    laid_out = ordering.sort_for_layout(df, files=4).withColumn("file", F.spark_partition_id())
    spans = sorted(
        (r["lo"], r["hi"]) for r in rows_of(laid_out.groupBy("file").agg(F.min("pickup_datetime").alias("lo"), F.max("pickup_datetime").alias("hi")))
    )
    assert len(spans) == 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_sample_is_the_first_rows_by_time(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, start + dt.timedelta(minutes=100 - i)) for i in range(100)], "id bigint, pickup_datetime timestamp")
    storage.write_combined_sample(df, str(tmp_path / "all"), str(tmp_path / "csv"), rows=3)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 100
    sample = storage.read_csv_header(spark, str(tmp_path / "csv"), "id bigint, pickup_datetime timestamp")
    assert sorted(r["id"] for r in rows_of(sample)) == [97, 98, 99]
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1


def test_cache_levels(spark):
    cached = storage.cache_df(spark.range(5), "DISK_ONLY")
    assert cached.storageLevel.useDisk and not cached.storageLevel.useMemory
    cached.unpersist()
    other = storage.cache_df(spark.range(6), "NO_SUCH_LEVEL")
    assert other.storageLevel.useDisk and other.storageLevel.useMemory
    other.unpersist()


@pytest.mark.parametrize("size_gb, count", [(0.5, 50), (1, 100), (4.9, 100), (5, 200), (9.9, 200), (10, 400), (1e5, 400)])
def test_recommended_partitions(spark, size_gb, count):
    assert storage.recommended_partitions(size_gb) == count
    df = spark.range(1).select(storage.recommended_partitions(F.lit(float(size_gb))).alias("n"))
    assert df.first()["n"] == count


def test_tuning_sets_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert storage.tune_for_size(spark, 7) == 200 and spark.conf.get("spark.sql.shuffle.partitions") == "200"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repartition_on_read(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "r"))
    assert storage.read_trips_parquet(spark, str(tmp_path / "r"), partitions=3).rdd.getNumPartitions() == 3


def test_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None)], "i int, s string, d double")
    storage.json_sink(df, str(tmp_path / "j"))
    assert rows_of(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows_of(df)
