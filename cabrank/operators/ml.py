"""Segments, regressions and histograms with Spark ML and SQL aggregates."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from cabrank.operators import aggregates as a
from cabrank.sources import storage

SEGMENT_FEATURES = ("total_trips", "avg_fare", "avg_customer_rating", "avg_tips", "avg_route_efficiency")
FARE_FEATURES = ("pickup_hour", "pickup_day_of_week", "trip_distance")


def segment_model(metrics: DataFrame, features=SEGMENT_FEATURES, k: int = 4, seed: int = 42) -> PipelineModel:
    """Standardised features and k-means, fitted on the cluster."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip"),
        StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True),
        KMeans(featuresCol="_scaled", predictionCol="cluster", k=k, seed=seed),
    ]
    return Pipeline(stages=stages).fit(metrics)


#: Steps of the segment search at most; it ends where no centre moves any more.
SEGMENT_STEPS = 25


def _apart(point: Column, centre: list[float]) -> Column:
    """Squared distance of a point from a centre."""
    return sum(((point[i] - F.lit(float(v))) * (point[i] - F.lit(float(v))) for i, v in enumerate(centre)), F.lit(0.0))


def _nearest(point: Column, centres: list[list[float]]) -> Column:
    """Number of the nearest centre, of equal ones the first."""
    distances = F.array(*[_apart(point, centre) for centre in centres])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def driver_segments(metrics: DataFrame, features=SEGMENT_FEATURES, k: int = 4, key: str = "driver_id", steps: int = SEGMENT_STEPS) -> DataFrame:
    """Drivers with their cluster number (k-means over standardised features); drivers that lack a feature are left out.

    The search does not depend on chance or on partitions. The first seed is the driver nearest to the mean of all, each further
    one the driver farthest from the seeds so far; ties go to the smallest key. Each step is one grouped
    aggregate over the points, which leaves k centres; a cluster that loses its last driver keeps its centre.
    """
    whole = metrics.dropna(subset=list(features))
    moments = whole.agg(*[f(n).alias(f"{name}_{i}") for i, n in enumerate(features) for name, f in (("mean", F.avg), ("spread", F.stddev_samp))]).first()

    def standard(i: int, name: str) -> Column:
        mean, spread = moments[f"mean_{i}"], moments[f"spread_{i}"]
        return (F.col(name) - F.lit(mean)) / F.lit(spread) if spread else F.lit(0.0)

    point = F.array(*[standard(i, name).cast("double") for i, name in enumerate(features)])
    points = storage.kept(whole.select(F.col(key).alias("key"), point.alias("point")))
    place = F.col("point")
    first = points.orderBy(_apart(place, [0.0] * len(features)), "key").first()
    if first is None:
        return whole.withColumn("cluster", F.lit(None).cast("int"))
    centres = [list(first.point)]
    while len(centres) < k:
        far = F.least(*[_apart(place, c) for c in centres], F.lit(float("inf")))
        centres.append(list(points.orderBy(far.desc(), "key").first().point))
    for _ in range(steps):
        means = points.groupBy(_nearest(place, centres).alias("cluster")).agg(*[F.avg(place[i]).alias(f"_{i}") for i in range(len(features))])
        moved = {r.cluster: [r[f"_{i}"] for i in range(len(features))] for r in means.collect()}
        before, centres = centres, [moved.get(i, centre) for i, centre in enumerate(centres)]
        if before == centres:
            break
    return whole.withColumn("cluster", _nearest(point, centres))


def segment_profile(segments: DataFrame, features=SEGMENT_FEATURES) -> DataFrame:
    """Mean features and size per cluster, with a label that compares a cluster to the mean of the clusters."""
    measures = [*features, "total_revenue"]
    profile = segments.groupBy("cluster").agg(*[a.mean(m, m) for m in measures], a.rows("driver_count"))
    overall = profile.agg(*[a.mean(m, f"_{m}") for m in measures])

    def above(m: str):
        return F.col(m) > F.col(f"_{m}")

    label = (
        F.when(above("avg_customer_rating") & above("avg_tips"), "Premium Service")
        .when(above("total_trips"), "High Volume Drivers")
        .when(F.col("total_revenue") < F.col("_total_revenue"), "Underperformers")
        .otherwise("Standard Performers")
    )
    return profile.crossJoin(F.broadcast(overall)).select(
        "cluster", *measures, "driver_count", label.alias("segment")
    )


def label_segments(segments: DataFrame, profile: DataFrame) -> DataFrame:
    """Segment label of every driver; a profile has k rows."""
    return segments.join(F.broadcast(profile.select("cluster", "segment")), "cluster", "left")


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope * x + intercept over all rows."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def fare_model(trips: DataFrame, features=FARE_FEATURES, target: str = "fare_amount") -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
        LinearRegression(featuresCol="features", labelCol=target, predictionCol="predicted"),
    ]
    return Pipeline(stages=stages).fit(trips)


def determinant(rows: list[list[Column]]) -> Column:
    """Determinant of a small matrix of columns, expanded along its first row."""
    if len(rows) == 1:
        return rows[0][0]
    total = F.lit(0.0)
    for i, value in enumerate(rows[0]):
        minor = determinant([row[:i] + row[i + 1 :] for row in rows[1:]])
        total = total + value * minor if i % 2 == 0 else total - value * minor
    return total


def fare_regression(trips: DataFrame, features=FARE_FEATURES, target: str = "fare_amount") -> DataFrame:
    """Coefficients and fit of the fare model by the normal equations, from one pass over the trips.

    Covariances are merged from partial results without cancellation, and the few equations are
    solved by Cramer's rule in the same query. Rows that lack a value are left out; linearly
    dependent features give null coefficients.
    """
    whole = trips.select(*[F.col(n).cast("double").alias(n) for n in (*features, target)]).dropna()
    names = [*features, target]
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    sums = whole.agg(
        a.rows("rows_used"),
        *[F.avg(n).alias(f"_mean_{n}") for n in names],
        *[F.covar_pop(x, y).alias(f"_cov_{x}_{y}") for x, y in pairs],
    )

    def covariance(x: str, y: str) -> Column:
        return F.col(f"_cov_{x}_{y}" if (x, y) in pairs else f"_cov_{y}_{x}")

    matrix = [[covariance(x, y) for y in features] for x in features]

    def coefficient(i: int) -> Column:
        replaced = [row[:i] + [covariance(x, target)] + row[i + 1 :] for x, row in zip(features, matrix)]
        return F.try_divide(determinant(replaced), determinant(matrix))

    solved = sums.withColumns({f"coef_{n}": coefficient(i) for i, n in enumerate(features)})
    explained = sum((F.col(f"coef_{n}") * covariance(n, target) for n in features), F.lit(0.0))
    spread = covariance(target, target)
    intercept = F.col(f"_mean_{target}") - sum((F.col(f"coef_{n}") * F.col(f"_mean_{n}") for n in features), F.lit(0.0))
    return solved.select(
        intercept.alias("intercept"), *[f"coef_{n}" for n in features], "rows_used",
        F.sqrt(F.greatest(spread - explained, F.lit(0.0))).alias("rmse"), F.try_divide(explained, spread).alias("r2"),
    )


def misplaced(segments: DataFrame, model: PipelineModel) -> DataFrame:
    """How many rows there are, and how many of them are not with the centre nearest to them (none, in a right result)."""
    centres = model.stages[-1].clusterCenters()  # k rows
    scaled = vector_to_array(F.col("_scaled"))

    def distance(centre) -> Column:
        return F.aggregate(
            F.zip_with(scaled, F.array(*[F.lit(float(v)) for v in centre]), lambda x, y: (x - y) * (x - y)),
            F.lit(0.0), lambda total, square: total + square,
        )

    distances = F.array(*[distance(centre) for centre in centres])
    own = F.element_at(distances, F.col("cluster") + 1)
    return model.transform(segments.drop("cluster")).agg(
        a.rows("row_count"), a.count_where(own > F.array_min(distances) + 1e-9, "misplaced")
    )


def predict_fares(trips: DataFrame, features=FARE_FEATURES, target: str = "fare_amount") -> DataFrame:
    return fare_model(trips, features, target).transform(trips).drop("features")


def histogram(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Equal-width bins between the smallest and the largest value of each measure (name -> number of bins).

    The last bin includes its upper end. When all values of a measure are equal
    its range is widened by one half on both sides. All measures are counted in
    one pass over the rows, after one pass for their ranges.
    """

    def edge(name: str, side, shift: float):
        plain = side(name).cast("double")
        return F.when(F.min(name) == F.max(name), plain + shift).otherwise(plain)

    edges = df.agg(
        *[edge(name, F.min, -0.5).alias(f"_lo_{name}") for name in bins],
        *[edge(name, F.max, 0.5).alias(f"_hi_{name}") for name in bins],
    )
    measures = F.array(
        *[
            F.struct(
                F.lit(name).alias("measure"), F.col(name).cast("double").alias("value"), F.lit(float(n)).alias("bins"),
                F.col(f"_lo_{name}").alias("lo"), F.col(f"_hi_{name}").alias("hi"),
            )
            for name, n in bins.items()
        ]
    )
    values = df.select(*bins).crossJoin(F.broadcast(edges)).select(F.inline(measures)).filter("value IS NOT NULL")
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins"))
    counted = values.groupBy(
        "measure", F.least(place, F.col("bins") - 1).cast("int").alias("bin"), "lo", "hi", "bins"
    ).agg(a.rows("row_count"))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    return counted.select(
        "measure",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        "row_count",
    )
