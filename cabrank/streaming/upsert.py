"""Tables kept up to date by micro-batches.

Every batch writes to a place of its own (a partition or a version named after
the batch id), so a batch that is repeated after a failure replaces its own
output and nothing is counted twice. What a batch reads and writes follows the batch: the parts of the state that it touches.
Which version of a part counts is said by small manifest tables that are written last, so a step that fails in between leaves
the state as it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cabrank.functions import columns as c
from cabrank.operators.clean import since_moment
from cabrank.plans.ride_demand import active_monitor
from cabrank.plans.trip_views import daily_from_partials, daily_partials


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process all data that has arrived, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a Parquet folder with exactly-once file commits."""
    run_available(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet folder; None before anything is written to it."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda one, other: one | other, conditions, F.lit(False))


# --- daily summary ----------------------------------------------------------


#: Partial results of so many batches of a month are merged into its base.
COMPACT_AFTER = 8


def stream_daily_upsert(trips: DataFrame, path: str, checkpoint: str, compact_after: int = COMPACT_AFTER) -> None:
    """Refresh the daily summary of the months that arriving valid trips belong to.

    Every trip is read once, in its batch; what is kept of it are partial
    results. The summary of a touched month is rebuilt from the month's base and the partial results
    of the batches after it, and only the partitions of these months are replaced. A month with many batches after its
    base gets a new base; the manifest then names the last batch in it, and earlier partial results are not read any more.
    """
    month = F.date_format("pickup_date", "yyyy-MM")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partials = daily_partials(batch).withColumns({"month": month, "batch": F.lit(batch_id).cast("long")})
        _replace_partitions(partials, f"{path}/partials", "month", "batch")
        stored = _stored(spark, f"{path}/partials")
        if stored is None:
            return
        # A batch touches a few calendar months.
        touched = [r.month for r in stored.filter(F.col("batch") == batch_id).select("month").distinct().collect()]
        if not touched:
            return
        bases = base_batches(spark, path, touched)
        summary = daily_from_partials(partial_results(spark, path, bases))
        _replace_partitions(summary.withColumn("month", F.date_format("summary_date", "yyyy-MM")), f"{path}/daily", "month")
        waiting = stored.filter(_after(bases)).groupBy("month").agg(F.countDistinct("batch").alias("n"))
        full = [r.month for r in waiting.filter(F.col("n") >= compact_after).collect()]
        if full:
            _compact(spark, path, {m: bases[m] for m in full}, batch_id)

    run_available(trips.writeStream.foreachBatch(refresh), checkpoint)


def base_batches(spark: SparkSession, path: str, months: list[str]) -> dict[str, int]:
    """The last batch in the base of each month, -1 for a month without one."""
    manifest = _stored(spark, f"{path}/manifest", "month string, last_batch long")
    found = {m: -1 for m in months}
    if manifest is not None:
        rows = manifest.filter(F.col("month").isin(months)).groupBy("month").agg(F.max("last_batch").alias("last_batch"))
        found.update({r.month: r.last_batch for r in rows.collect()})
    return found


def _after(bases: dict[str, int]) -> Column:
    """Partial results that are not in a base; literal, so only their partitions are read."""
    return _any([(F.col("month") == m) & (F.col("batch") > last) for m, last in bases.items()])


def partial_results(spark: SparkSession, path: str, bases: dict[str, int]) -> DataFrame:
    """All partial results of the months: their bases and what came after them."""
    later = spark.read.parquet(f"{path}/partials").filter(_after(bases)).drop("batch")
    based = {m: last for m, last in bases.items() if last >= 0}
    if not based:
        return later
    chosen = _any([(F.col("month") == m) & (F.col("last_batch") == last) for m, last in based.items()])
    return spark.read.parquet(f"{path}/base").filter(chosen).drop("last_batch").unionByName(later)


def _compact(spark: SparkSession, path: str, bases: dict[str, int], batch_id: int) -> None:
    """New bases up to the batch. They count from the moment the manifest names them; until then a repeated step replaces them."""
    rows = partial_results(spark, path, bases)
    sums = [n for n in rows.columns if n.startswith("_")]
    merged = rows.groupBy(*[n for n in rows.columns if n not in sums]).agg(*[F.sum(n).alias(n) for n in sums])
    _replace_partitions(merged.withColumn("last_batch", F.lit(batch_id).cast("long")), f"{path}/base", "month", "last_batch")
    entries = spark.createDataFrame([(m, batch_id) for m in bases], "month string, last_batch long")
    entries.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/daily").drop("month")


# --- active rides -----------------------------------------------------------


# How far a ride has come; a ride that ended, one way or the other, stays ended.
PROGRESS = {"Requested": 1, "InProgress": 2, "Completed": 3, "Cancelled": 3}


def latest_status(
    changes: DataFrame,
    key: str = "ride_id",
    changed: str | None = None,
    status: str = "trip_status",
) -> DataFrame:
    """The most recent row of every ride.

    ``changed`` names the time of a change, if the source has one. Without it, and among
    changes of the same time, the row that has come furthest counts; its pickup time says
    nothing, as a ride keeps that while its status changes. Other ties are decided by the
    remaining columns, so the result does not depend on the order of arrival.
    """
    progress = F.coalesce(c.label(status, PROGRESS), F.lit(0)).alias("_progress")
    first = ([changed] if changed else []) + [progress]
    others = [n for n in changes.columns if n not in (key, changed)]
    newest = F.max(F.struct(*first, *others)).alias("_row")
    rows = changes.groupBy(key).agg(newest).select(key, "_row.*")
    return rows.select(changes.columns)


#: Parts of the state, by a hash of the key.
BUCKETS = 32


def stream_active_monitor(
    rides: DataFrame, path: str, checkpoint: str, interval: str = "4 hours", changed: str | None = None, key: str = "ride_id", buckets: int = BUCKETS
) -> None:
    """Keep the latest status of all rides of the last hours, and a monitor row per batch.

    ``changed`` names the time of a status change, see ``latest_status``.

    The state is cut into buckets of keys. A batch reads and rewrites the buckets of its own keys, each without the rides that are
    older than the interval before the latest event; others keep their version. ``versions`` lists the buckets a batch has written
    and the latest event so far; it is written after them, so a repeated batch starts from the versions before it.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        seen = batch.agg(F.max("pickup_datetime")).first()[0]
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most as many as buckets
        before, latest = bucket_versions(spark, path, batch_id - 1)
        latest = max((t for t in (seen, latest) if t is not None), default=None)
        old = state_rows(spark, path, {b: v for b, v in before.items() if b in touched})
        merged = latest_status(rows if old is None else old.unionByName(rows), key, changed)
        if touched:
            current = since_moment(merged, latest, interval).withColumn("version", F.lit(batch_id).cast("long"))
            _replace_partitions(current, f"{path}/state", "bucket", "version")
        entries = spark.createDataFrame([(b, latest) for b in touched], "bucket int, latest timestamp")
        entries.coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/version={batch_id}")
        state = state_rows(spark, path, {**before, **dict.fromkeys(touched, batch_id)})
        monitor = active_monitor((rows if state is None else state).drop("bucket"), latest, interval)
        monitor.write.mode("overwrite").parquet(f"{path}/monitor/version={batch_id}")

    run_available(rides.writeStream.foreachBatch(step), checkpoint)


def bucket_versions(spark: SparkSession, path: str, up_to: int):
    """The version of each bucket after a batch, and the latest event by then."""
    listed = _stored(spark, f"{path}/versions", "bucket int, latest timestamp, version long")
    if listed is None:
        return {}, None
    rows = listed.filter(F.col("version") <= up_to).groupBy("bucket").agg(F.max("version").alias("version"), F.max("latest").alias("latest")).collect()
    return {r.bucket: r.version for r in rows}, max((r.latest for r in rows if r.latest is not None), default=None)


def state_rows(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame | None:
    """The rows of the given versions of buckets; the conditions are literal, so no other files are read."""
    stored = _stored(spark, f"{path}/state") if versions else None
    if stored is None:
        return None
    chosen = _any([(F.col("bucket") == b) & (F.col("version") == v) for b, v in versions.items()])
    return stored.filter(chosen).drop("version")


def read_monitor(spark: SparkSession, path: str) -> DataFrame:
    """Monitor rows, one per batch; the highest version is the current one."""
    return spark.read.parquet(f"{path}/monitor")
