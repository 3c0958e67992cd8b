import numpy as np
import pytest
from pyspark.sql import functions as F

from cabrank.operators import ml
from cabrank.plans import ride_drivers
from conftest import rows_of


@pytest.fixture(scope="module")
def segments(bound):
    metrics = ride_drivers.driver_metrics(bound.drivers, bound.rides)
    return metrics, ml.driver_segments(metrics)


def test_every_driver_gets_one_cluster(segments):
    metrics, clustered = segments
    assert clustered.count() == metrics.count()
    assert {r["cluster"] for r in rows_of(clustered.select("cluster"))} <= set(range(4))


def test_clusters_beat_a_single_centre(segments):
    metrics, _ = segments
    model = ml.segment_model(metrics)
    assert model.stages[-1].summary.trainingCost < ml.segment_model(metrics, k=1 + 1).stages[-1].summary.trainingCost


def test_profile_sizes_add_up_and_labels_are_attached(segments):
    metrics, clustered = segments
    profile = ml.segment_profile(clustered)
    rows = rows_of(profile)
    assert sum(r["driver_count"] for r in rows) == metrics.count()
    assert {r["segment"] for r in rows} <= {"Premium Service", "High Volume Drivers", "Underperformers", "Standard Performers"}
    assert ml.label_segments(clustered, profile).filter("segment IS NULL").count() == 0


def test_profile_labels_follow_the_rules(spark):
    names = ["avg_fare", "avg_route_efficiency", "avg_customer_rating", "avg_tips", "total_trips", "total_revenue", "cluster"]
    values = [(1.0, 1.0, 5.0, 9.0, 10.0, 10.0, 0), (1.0, 1.0, 1.0, 1.0, 90.0, 10.0, 1), (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2),
              (1.0, 1.0, 1.0, 1.0, 1.0, 90.0, 3)]
    profile = ml.segment_profile(spark.createDataFrame(values, names))
    assert {r["cluster"]: r["segment"] for r in rows_of(profile)} == {
        0: "Premium Service", 1: "High Volume Drivers", 2: "Underperformers", 3: "Standard Performers",
    }


def test_regression_equals_least_squares(bound):
    row = rows_of(ml.fare_regression(bound.trips))[0]
    data = np.array([tuple(r) for r in bound.trips.select(*ml.FARE_FEATURES, "fare_amount").collect()], dtype=float)
    design = np.column_stack([np.ones(len(data)), data[:, :3]])
    solved, *_ = np.linalg.lstsq(design, data[:, 3], rcond=None)
    ours = [row["intercept"], *[row[f"coef_{n}"] for n in ml.FARE_FEATURES]]
    assert np.allclose(ours, solved, rtol=1e-6)
    residual = data[:, 3] - design @ solved
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean(residual**2)), rel=1e-6)
    assert row["rows_used"] == len(data)
    assert ml.predict_fares(bound.trips).filter(F.col("predicted").isNull()).count() == 0


def test_trend_line(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "x double, y double")
    row = rows_of(ml.trend_line(df, "x", "y"))[0]
    assert row == {"slope": pytest.approx(2.0), "intercept": pytest.approx(1.0)}


def test_histogram_equals_numpy(spark):
    values = [float(v) for v in np.random.default_rng(3).normal(size=500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    ours = {r["bin"]: r["row_count"] for r in rows_of(ml.histogram(df, {"x": 20}))}
    counts, _ = np.histogram(values, bins=20)
    assert ours == {i: int(n) for i, n in enumerate(counts) if n}


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "x double")
    assert rows_of(ml.histogram(df, {"x": 10})) == [
        {"measure": "x", "bin": 5, "bin_start": pytest.approx(4.0), "bin_end": pytest.approx(4.1), "row_count": 3}
    ]
