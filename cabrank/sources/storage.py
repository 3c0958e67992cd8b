"""Readers, writers and catalogue helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window, functions as F

from cabrank.operators.ordering import sort_for_layout
from cabrank.sources import schemas


# --- scratch space ----------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="run-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder, cut off from the plan that made it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


# --- readers ----------------------------------------------------------------


def read_trips_parquet(spark: SparkSession, path: str | list[str], partitions: int | None = None, schema=None) -> DataFrame:
    """Trip files; ``partitions`` forces a shuffle and is only needed for a few huge unsplittable files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.repartition(partitions) if partitions else df


def read_csv_header(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line and a given schema; inferring one would read the data twice."""
    return spark.read.schema(schema).option("header", True).csv(path)


#: Column with the line of a record that could not be read.
BROKEN = "_broken_line"


def read_csv_checked(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """CSV with a header line as (accepted rows, rejected lines).

    A line is rejected as a whole if a value does not fit its type or if it has too few or too many values;
    it is kept as it stands in the column ``BROKEN``. An empty value is a null, not an error.
    """
    reader = spark.read.schema(f"{schema}, {BROKEN} string").option("header", True).option("mode", "PERMISSIVE")
    # Without pruning every line is parsed in full, so the result does not depend on the columns that are asked for.
    rows = reader.option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).csv(path)
    # Spark refuses to read nothing but the broken lines, so the other columns are always asked for too.
    parsed = F.length(F.concat_ws("", *[n for n in rows.columns if n != BROKEN])) >= 0
    return rows.filter(F.col(BROKEN).isNull() & parsed).drop(BROKEN), rows.filter(F.col(BROKEN).isNotNull() & parsed)


def read_table(spark: SparkSession, names: Iterable[str], schema: str) -> DataFrame:
    """The first of the named tables or views that exists, else an empty frame of the schema."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return spark.createDataFrame([], schema)


# --- writers ----------------------------------------------------------------


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite", by: str | Iterable[str] = ()) -> None:
    """Parquet, optionally partitioned.

    Before a partitioned write the rows are rebalanced by partition value:
    adaptive execution splits a value that is far larger than the others over
    several tasks and merges small ones, so there is neither one overlong task
    nor one small file per task and value.
    """
    by = [by] if isinstance(by, str) else list(by)
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_combined_sample(df: DataFrame, path: str, sample_path: str, rows: int = 10_000) -> None:
    """All rows as Parquet laid out by pickup time, and the first rows by pickup time as one CSV file.

    The sample comes from the files just written, of which only those are read that begin before its last row.
    """
    sort_for_layout(df).write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    files = files_with_first(written, rows)
    first = df.sparkSession.read.schema(df.schema).parquet(*files) if files else written
    others = [n for n in df.columns if n != "pickup_datetime"]
    first = first.orderBy("pickup_datetime", *others).limit(rows)
    first.coalesce(1).write.mode("overwrite").option("header", True).csv(sample_path)


def files_with_first(written: DataFrame, rows: int, order: str = "pickup_datetime") -> list[str]:
    """The files, laid out by ``order``, that hold its first rows; a column of theirs is read, and one row per file is ordered."""
    spans = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(order).alias("least"), F.max(order).alias("most"), F.count(F.lit(1)).alias("n"), F.count(order).alias("timed")
    )
    start = F.when(F.col("n") == F.col("timed"), F.col("least"))  # null, which comes first, where a row has no time
    ordered = Window.orderBy(F.col("start").asc_nulls_first(), "file")
    running = spans.withColumn("start", start).withColumn("before", F.sum("n").over(ordered) - F.col("n"))
    last = running.filter(F.col("before") < rows).agg(F.max("most")).scalar()
    return [r.file for r in running.filter((F.col("before") < rows) | (F.col("start") <= last)).select("file").collect()]


def first_rows(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """The first rows by pickup time; equal times are ordered by the other columns.

    A sort with a limit sends that many rows of every task to a single one.
    Counting rows per day, and then per minute of the decisive day, gives a time
    behind which no wanted row lies; only the few rows before it are sorted.
    """
    time = F.col("pickup_datetime")
    day = _holding_row(df.groupBy(F.to_date(time).alias("_t")), rows)
    early = df.filter(day.isNull() | (F.to_date(time) <= day) | time.isNull())
    minute = _holding_row(early.groupBy(F.date_trunc("minute", time).alias("_t")), rows)
    few = early.filter(minute.isNull() | (F.date_trunc("minute", time) <= minute) | time.isNull())
    others = [n for n in df.columns if n != "pickup_datetime"]
    return few.orderBy("pickup_datetime", *others).limit(rows)


def _holding_row(periods: GroupedData, n: int) -> Column:
    """First period in which the n-th row lies (null when there are fewer rows), as a scalar subquery.

    The window has one row per period.
    """
    counts = periods.agg(F.count(F.lit(1)).alias("_n"))
    running = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_t")))
    return running.filter(F.col("_upto") >= n).agg(F.min("_t")).scalar()


def _for_table(df: DataFrame, table: str) -> DataFrame:
    """Columns in the order of the table, rows brought together by its partition columns."""
    columns = df.sparkSession.catalog.listColumns(table)
    by = [column.name for column in columns if column.isPartition]
    rows = df.select(*[column.name for column in columns])
    return rows.hint("rebalance", *by) if by else rows


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to an existing table, matching columns by name."""
    _for_table(df, table).write.insertInto(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a table, or of a partitioned table just the partitions present in the new rows.

    An insert takes the overwrite mode from the session, not from its options,
    so the session's own mode is put back afterwards.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        _for_table(df, table).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def json_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# --- verified loads ---------------------------------------------------------


def batch_sums(df: DataFrame, *by: str) -> DataFrame:
    """Rows and an order-free checksum per group: a changed, a lost and a doubled row each change it."""
    columns = [n for n in df.columns if n not in by]
    content = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(content).alias("checksum"))


def load_verified(df: DataFrame, path: str, batches: int = 16) -> DataFrame:
    """Load rows into ``path`` in batches by their content, compare every batch with its source, and return the comparison.

    The manifest beside the rows holds what every batch should have. A load that is repeated, as after a failure, looks at what is
    there and writes only the batches that are missing or differ, so it adds nothing twice.
    """
    spark = df.sparkSession
    rows = df.withColumn("batch", F.pmod(F.xxhash64(*df.columns), F.lit(batches)).cast("int"))
    kept(batch_sums(rows, "batch")).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    report = verify_load(spark, path, df.schema)
    wrong = [r.batch for r in report.filter("NOT verified").select("batch").collect()]  # at most as many as batches
    if wrong:
        again = rows.filter(F.col("batch").isin(wrong)).hint("rebalance", "batch")
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/rows")
        report = verify_load(spark, path, df.schema)
    return report


def loaded_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a verified load; none before the first batch is written."""
    try:
        return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def verify_load(spark: SparkSession, path: str, schema) -> DataFrame:
    """What the manifest expects of every batch, and what is there: batch, rows, loaded_rows, verified."""
    with_batch = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, batch int"
    there = batch_sums(loaded_rows(spark, path, with_batch), "batch").toDF("batch", "loaded_rows", "loaded_checksum")
    both = spark.read.parquet(f"{path}/manifest").join(there, "batch", "full")
    same = F.col("rows").eqNullSafe(F.col("loaded_rows")) & F.col("checksum").eqNullSafe(F.col("loaded_checksum"))
    counts = [F.coalesce(n, F.lit(0)).alias(n) for n in ("rows", "loaded_rows")]
    return both.select("batch", *counts, same.alias("verified"))


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 50_000, **options: str) -> None:
    """Load a database table in batches, in parallel from the executors."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_rows), **options).mode("append").save()


# --- catalogue and session --------------------------------------------------


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create_tables(spark: SparkSession, database: str, location: str, replace: bool = True) -> list[str]:
    """(Re)create the warehouse tables of a database as Parquet tables below a location; returns their names."""
    names = []
    for table, (columns, partitions) in schemas.WAREHOUSE.items():
        name = f"{database}.{table}"
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET {by} LOCATION '{location}/{table}'")
        names.append(name)
    return names


def create_ride_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """(Re)create the tables of the ride service, which share some names with the warehouse: keep them apart."""
    names = []
    for table, columns in schemas.RIDE_TABLES.items():
        name = f"{database}.{table}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET LOCATION '{location}/{table}'")
        names.append(name)
    return names


def create_views(**frames: DataFrame) -> None:
    """Register frames as session views; names have one part."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def refresh_statistics(spark: SparkSession, table: str) -> None:
    """Row count and size for the optimizer; the caller decides when a scan for it is worth it."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
    "MEMORY_ONLY_SER": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK_SER": StorageLevel.MEMORY_AND_DISK,
}


def cache_df(df: DataFrame, level: str = "MEMORY_AND_DISK") -> DataFrame:
    """Persist at a named level; an unknown name means MEMORY_AND_DISK. The caller unpersists."""
    return df.persist(LEVELS.get(level, StorageLevel.MEMORY_AND_DISK))


def recommended_partitions(size_gb):
    """Shuffle partitions for a data size in GB; works on a number or on a column."""
    steps = ((1, 50), (5, 100), (10, 200))
    if isinstance(size_gb, (int, float)):
        return next((count for bound, count in steps if size_gb < bound), 400)
    chain = F
    for bound, count in steps:
        chain = chain.when(size_gb < bound, count)
    return chain.otherwise(400)


def tune_for_size(spark: SparkSession, size_gb: float) -> int:
    """Set the shuffle partitions for a data size. Adaptive execution merges small ones again."""
    count = recommended_partitions(size_gb)
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count
