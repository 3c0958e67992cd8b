"""Readers, writers and catalogue helpers, each as a round trip through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from cabrank.operators import aggregates as a, clean, joins, quality
from cabrank.plans import trip_business, trip_views
from cabrank.registry.base import DERIVED_FLOATS, add
from cabrank.registry.trip_reports import MONTHLY, MONTHLY_FLOATS
from cabrank.sources import schemas, storage

CORE = [
    "pickup_datetime", "trip_key", "total_amount", "trip_type", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "trip_distance", "fare_amount", "payment_type",
]
CORE_SQL = ", ".join(CORE)


def wide(trips: DataFrame) -> DataFrame:
    """Trips with all their columns, those of CORE first: equal pickup times are ordered by them."""
    return trips.select(*CORE, *[c for c in trips.columns if c not in CORE])


def _zoned(df: DataFrame) -> DataFrame:
    """Times with a zone, as the curated table and text formats hold them."""
    return df.withColumns({n: F.col(n).cast("timestamp") for n in ("pickup_datetime", "dropoff_datetime")})


add("read_trips_parquet", lambda b: b.table("lineitem"),
    "SELECT * FROM lineitem")


def raw_dialect(trips: DataFrame, kind: str) -> DataFrame:
    """Trips of one type under the column names of the raw files."""
    of_kind = _zoned(trips.filter(F.col("trip_type") == kind))
    names = {raw: name for raw, name in schemas.RAW_COLUMNS[kind].items() if name in trips.columns}
    return of_kind.select("trip_key", *[F.col(name).alias(raw) for raw, name in names.items()])


def csv_round_trip(b, kind: str) -> DataFrame:
    path = storage.scratch_path(b.spark, "csv")
    rows = raw_dialect(b.trips_raw, kind)
    rows.write.option("header", True).csv(path)
    kinds = dict(rows.dtypes)
    return storage.read_csv_header(b.spark, path, ", ".join(f"`{n}` {kinds[n]}" for n in rows.columns))


for _name, _kind, _prefix in (("read_csv_header", "yellow", "tpep"), ("read_csv_header_green", "green", "lpep")):
    add(_name, lambda b, kind=_kind: csv_round_trip(b, kind), f"""
SELECT trip_key, pickup_datetime AS {_prefix}_pickup_datetime, dropoff_datetime AS {_prefix}_dropoff_datetime,
  pickup_location_id AS "PULocationID", dropoff_location_id AS "DOLocationID", passenger_count, trip_distance, fare_amount,
  tip_amount, tolls_amount, total_amount, payment_type, rate_code_id AS "RatecodeID", store_and_fwd_flag,
  vendor_id AS "VendorID"
FROM trips_raw WHERE trip_type = '{_kind}'
""")


#: What is wrong with every so many lines: a number that is none, a value too few, a value too many.
FAULTS = {3: "x", 5: None, 7: "1,1"}


def checked_csv(b) -> DataFrame:
    """Trips as text with broken lines among them, read back: accepted rows with their values, rejected ones by their line."""
    path = storage.scratch_path(b.spark, "broken")
    line = F.concat_ws(",", "trip_key", "trip_type", F.coalesce(F.col("passenger_count").cast("string"), F.lit("")), "trip_distance")
    for every, last in FAULTS.items():
        start = F.concat_ws(",", "trip_key", "trip_type", F.lit("1"))
        line = F.when(F.col("trip_key") % every == 0, start if last is None else F.concat_ws(",", start, F.lit(last))).otherwise(line)
    # Every part of the folder is a file with a header of its own.
    rows = b.trips_raw.select(line.alias("trip_key,trip_type,passenger_count,trip_distance"))
    rows.write.option("header", True).option("quote", "").option("escapeQuotes", False).option("sep", "\u0001").csv(path)
    accepted, rejected = storage.read_csv_checked(b.spark, path, "trip_key bigint, trip_type string, passenger_count int, trip_distance double")
    lost = rejected.select(
        F.split(storage.BROKEN, ",")[0].cast("bigint").alias("trip_key"), F.lit(None).cast("string").alias("trip_type"),
        F.lit(None).cast("int").alias("passenger_count"), F.lit(None).cast("double").alias("trip_distance"),
    )
    return accepted.withColumn("status", F.lit("accepted")).unionByName(lost.withColumn("status", F.lit("rejected")))


add("read_csv_checked", checked_csv, """
WITH b AS (SELECT *, trip_key % 3 = 0 OR trip_key % 5 = 0 OR trip_key % 7 = 0 AS bad FROM trips_raw)
SELECT trip_key, CASE WHEN NOT bad THEN trip_type END AS trip_type, CASE WHEN NOT bad THEN passenger_count END AS passenger_count,
  CASE WHEN NOT bad THEN trip_distance END AS trip_distance, CASE WHEN bad THEN 'rejected' ELSE 'accepted' END AS status
FROM b
""")


def table_or_fallback(b) -> DataFrame:
    name = f"curated_{uuid.uuid4().hex}"
    storage.create_views(**{name: wide(b.trips)})
    found = storage.read_table(b.spark, ["no_such_table", name], schemas.CURATED_TRIPS)
    b.spark.catalog.dropTempView(name)
    return found


add("read_table", table_or_fallback, "SELECT * FROM trips", DERIVED_FLOATS)


def partitioned_round_trip(b) -> DataFrame:
    path = storage.scratch_path(b.spark, "partitioned")
    storage.write_partitioned(wide(b.trips), path, by="trip_type")
    return b.spark.read.parquet(path)


add("write_partitioned", partitioned_round_trip, "SELECT * FROM trips", DERIVED_FLOATS)


def combined_sample(b) -> DataFrame:
    path = storage.scratch_path(b.spark, "combined")
    rows = _zoned(wide(b.trips))
    storage.write_combined_sample(rows, f"{path}/all", f"{path}/sample")
    kinds = dict(rows.dtypes)
    sample = storage.read_csv_header(b.spark, f"{path}/sample", ", ".join(f"{n} {kinds[n]}" for n in rows.columns))
    total = b.spark.read.parquet(f"{path}/all").agg(a.rows("written_rows"))
    return sample.crossJoin(F.broadcast(total))


add("write_combined_sample", combined_sample, f"""
SELECT *, (SELECT count(*) FROM trips) AS written_rows FROM trips ORDER BY {CORE_SQL} LIMIT 10000
""", DERIVED_FLOATS)


def new_warehouse(b) -> str:
    database = f"warehouse_{uuid.uuid4().hex}"
    path = storage.scratch_path(b.spark, "warehouse")
    storage.create_database(b.spark, database, path)
    storage.create_tables(b.spark, database, path)
    return database


def curated(b, kind: str | None = None) -> DataFrame:
    """Trips in the layout of the stored table."""
    rows = b.trips_all if kind is None else b.trips_all.filter(F.col("trip_type") == kind)
    rows = rows.withColumns({"trip_id": F.col("trip_key"), "created_at": F.current_timestamp()})
    return rows.withColumns({n: F.col(n).cast("timestamp") for n in ("pickup_datetime", "dropoff_datetime")})


def appended(b) -> DataFrame:
    table = f"{new_warehouse(b)}.trips"
    for kind in ("yellow", "green"):
        storage.append_table(curated(b, kind), table)
    return b.spark.table(table).groupBy("pickup_year", "pickup_month", "trip_type").agg(
        a.rows(), a.total("total_amount", "total_revenue"), a.count_where(F.col("is_valid_trip"), "valid_trips")
    )


add("append_table", appended, """
SELECT pickup_year, pickup_month, trip_type, count(*) AS trip_count, sum(total_amount) AS total_revenue,
  count(*) FILTER (is_valid_trip) AS valid_trips
FROM trips_all GROUP BY 1, 2, 3
""", "total_revenue")


def overwritten(b) -> DataFrame:
    """All years are loaded, the early ones with wrong counts; then only the early years are replaced."""
    table = f"{new_warehouse(b)}.monthly_statistics"
    summary = trip_views.stamped(trip_views.monthly_statistics(b.trips))
    early = F.col("pickup_year") <= 1998
    wrong = F.when(early, F.lit(0)).otherwise(F.col("total_trips")).cast("bigint")
    storage.overwrite_table(summary.withColumn("total_trips", wrong), table)
    storage.overwrite_table(summary.filter(early), table)
    return b.spark.table(table).drop("updated_at")


add("overwrite_table", overwritten, MONTHLY, MONTHLY_FLOATS)


def json_round_trip(b) -> DataFrame:
    path = storage.scratch_path(b.spark, "json")
    storage.json_sink(b.rides, path)
    return b.spark.read.schema(b.rides.schema).json(path)


add("json_sink", json_round_trip, "SELECT * FROM rides")


def load_and_verify(b) -> DataFrame:
    """A verified load that is repeated: what is there then, and how many of its batches differ from the source."""
    path = storage.scratch_path(b.spark, "load")
    # The trips come from three joins, and a load reads its source twice: they are joined once and read as columns.
    storage.write_partitioned(b.trips_all, f"{path}/source")
    trips = storage.read_trips_parquet(b.spark, f"{path}/source", schema=b.trips_all.schema)
    for _ in range(2):
        checked = storage.load_verified(trips, path)
    failed = checked.agg(a.count_where(~F.col("verified"), "failed_batches"), F.sum("loaded_rows").alias("checked_rows"))
    loaded = storage.loaded_rows(b.spark, path, b.trips_all.schema)
    return quality.load_report(loaded).crossJoin(F.broadcast(failed))


LOAD_REPORT = """
SELECT count(*) AS total_trips, count(*) FILTER (is_valid_trip) AS valid_trips, min(pickup_datetime) AS min_date,
  max(pickup_datetime) AS max_date, count(*) FILTER (trip_type = 'yellow') AS yellow_trips,
  count(*) FILTER (trip_type = 'green') AS green_trips,
  round((count(*) FILTER (is_valid_trip) * 100.0 / count(*))::DECIMAL(30,9), 1)::DOUBLE AS valid_pct
FROM trips_all
"""
add("jdbc_load_verify", load_and_verify, f"""
SELECT *, CAST(0 AS BIGINT) AS failed_batches, total_trips AS checked_rows FROM ({LOAD_REPORT})
""")
add("load_report", lambda b: quality.load_report(b.trips_all), LOAD_REPORT)


def cached_reports(b) -> DataFrame:
    """Two reports over one cached set of trips, stored before the cache is given back."""
    path = storage.scratch_path(b.spark, "reports")
    trips = storage.cache_df(b.trips.select("trip_type", "pickup_date", "total_amount", "payment_type"))
    by_type = trips.groupBy(F.col("trip_type").alias("label")).agg(a.rows(), a.total("total_amount", "total_revenue"))
    by_payment = trips.groupBy(F.col("payment_type").cast("string").alias("label")).agg(
        a.rows(), a.total("total_amount", "total_revenue")
    )
    by_type.unionByName(by_payment).write.parquet(path)
    trips.unpersist()
    return b.spark.read.parquet(path)


add("cache_df", cached_reports, """
SELECT trip_type AS label, count(*) AS trip_count, sum(total_amount) AS total_revenue FROM trips GROUP BY 1
UNION ALL
SELECT payment_type::VARCHAR, count(*), sum(total_amount) FROM trips GROUP BY 1
""", "total_revenue")


def through_views(b) -> DataFrame:
    names = {n: f"{n}_{uuid.uuid4().hex}" for n in ("trips", "zones", "trips_with_zones")}
    storage.create_views(
        **{names["trips"]: b.trips, names["zones"]: b.zones, names["trips_with_zones"]: b.tz}
    )
    result = b.spark.sql(
        f"""SELECT v.pickup_zone, v.trip_count, z.service_zone
            FROM (SELECT pickup_location_id, pickup_zone, count(*) AS trip_count
                  FROM {names['trips_with_zones']} GROUP BY 1, 2) v
            JOIN {names['zones']} z ON v.pickup_location_id = z.location_id"""
    )
    for name in names.values():
        b.spark.catalog.dropTempView(name)
    return result


add("create_views", through_views, """
SELECT pickup_zone, count(*) AS trip_count, pickup_service_zone AS service_zone FROM tz GROUP BY ALL
""")


def loaded_warehouse(b) -> DataFrame:
    """All warehouse tables created and filled, then counted."""
    database = new_warehouse(b)
    storage.append_table(curated(b), f"{database}.trips")
    storage.append_table(b.zones.withColumn("created_at", F.current_timestamp()), f"{database}.zones")
    trips = clean.valid_trips(b.spark.table(f"{database}.trips"))
    zoned = joins.trips_with_zones(trips, b.spark.table(f"{database}.zones"))
    storage.overwrite_table(trip_views.stamped(trip_views.trip_summary_daily(trips)), f"{database}.trip_summary_daily")
    storage.overwrite_table(trip_views.stamped(trip_views.trip_summary_hourly(zoned)), f"{database}.trip_summary_hourly")
    storage.overwrite_table(trip_views.stamped(trip_views.monthly_statistics(trips)), f"{database}.monthly_statistics")
    counts = None
    for table in schemas.WAREHOUSE:
        one = b.spark.table(f"{database}.{table}").agg(F.lit(table).alias("table_name"), a.rows("row_count"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


add("create_tables", loaded_warehouse, """
SELECT 'trips' AS table_name, (SELECT count(*) FROM trips_all) AS row_count
UNION ALL SELECT 'zones', (SELECT count(*) FROM zones)
UNION ALL SELECT 'trip_summary_daily', (SELECT count(DISTINCT pickup_date) FROM trips)
UNION ALL SELECT 'trip_summary_hourly', (SELECT count(*) FROM (SELECT DISTINCT pickup_date, pickup_hour, trip_type, pickup_borough FROM tz))
UNION ALL SELECT 'monthly_statistics', (SELECT count(*) FROM (SELECT DISTINCT pickup_year, pickup_month, trip_type FROM trips))
""")
