import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabrank.operators import percentiles as p
from conftest import plan_of, rows_of

SPECS = {"p0": ("x", 0.0), "p10": ("x", 0.1), "p50": ("x", 0.5), "p95": ("x", 0.95), "p100": ("x", 1.0), "y50": ("y", 0.5)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, x double, y double").repartition(5)


def by_group(df):
    return {r["g"]: {k: v for k, v in r.items() if k != "g"} for r in rows_of(df)}


def assert_same(left, right):
    assert left.keys() == right.keys()
    for g in left:
        for name in left[g]:
            a, b = left[g][name], right[g][name]
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12), (g, name, a, b)


@pytest.mark.parametrize("shape", ["normal", "ties", "skewed", "constant", "tiny"])
def test_brackets_equal_builtin_and_numpy(spark, shape):
    rng = random.Random(shape)
    draw = {
        "normal": lambda: rng.gauss(0, 50),
        "ties": lambda: float(rng.randint(-3, 3)),
        "skewed": lambda: math.exp(rng.gauss(0, 6)),
        "constant": lambda: 7.0,
        "tiny": lambda: 40.7 + rng.random() * 1e-9,
    }[shape]
    rows = [("hot", draw(), draw()) for _ in range(3000)]
    rows += [(rng.choice("abc"), draw(), None if rng.random() < 0.3 else draw()) for _ in range(2000)]
    rows += [("one", 5.0, None), (None, draw(), draw()), (None, draw(), draw())]
    df = frame(spark, rows)
    ranges = by_group(p.grouped(df, ["g"], [], SPECS))
    builtin = df.groupBy("g").agg(*[F.percentile(column, share).alias(name) for name, (column, share) in SPECS.items()])
    assert_same(ranges, by_group(builtin))
    hot = np.array([r[1] for r in rows if r[0] == "hot"])
    assert ranges["hot"]["p95"] == pytest.approx(np.percentile(hot, 95), rel=1e-12, abs=1e-12)
    assert ranges["one"] == {"p0": 5.0, "p10": 5.0, "p50": 5.0, "p95": 5.0, "p100": 5.0, "y50": None}


def test_group_without_values_keeps_its_aggregates(spark):
    df = frame(spark, [("a", None, None), ("a", None, 1.0), ("b", 2.0, None)])
    result = by_group(p.grouped(df, ["g"], [F.count(F.lit(1)).alias("n")], {"m": ("x", 0.5)}))
    assert result == {"a": {"n": 2, "m": None}, "b": {"n": 1, "m": 2.0}}


def test_no_keys_and_no_rows(spark):
    df = frame(spark, [("a", 1.0, None), ("a", 2.0, None), ("b", 4.0, None)])
    assert rows_of(p.grouped(df, [], [F.sum("x").alias("s")], {"m": ("x", 0.5)})) == [{"s": 7.0, "m": 2.0}]
    empty = df.filter("x < 0")
    assert rows_of(p.grouped(empty, [], [F.count("x").alias("n")], {"m": ("x", 0.5)})) == [{"n": 0, "m": None}]
    assert rows_of(p.grouped(empty, ["g"], [], {"m": ("x", 0.5)})) == []


@pytest.mark.parametrize("accuracy, margin", [(3, 0), (10, 0), (50, 0.1), (10_000, 2)])
def test_missed_ranks_are_counted_again(spark, accuracy, margin):
    rng = random.Random(accuracy)
    rows = [(rng.choice("ab"), rng.choice([rng.random(), float(rng.randint(0, 5))]), rng.gauss(0, 1)) for _ in range(3000)]
    df = frame(spark, [*rows, (None, math.inf, -math.inf), ("c", -0.0, 0.0)])
    builtin = df.groupBy("g").agg(*[F.percentile(column, share).alias(name) for name, (column, share) in SPECS.items()])
    finite = df.filter("x < 1e9")
    assert_same(by_group(p.grouped(finite, ["g"], [], SPECS, accuracy, margin)), by_group(builtin.filter("g IS NOT NULL")))


def test_only_values_inside_the_brackets_are_shuffled(spark):
    rng = random.Random(4)
    df = frame(spark, [("a", rng.random(), None) for _ in range(40_000)])
    wanted = {"x": [("p50", 0.5), ("p90", 0.9)]}
    edges = [F.lit(v) for v in (0.499, 0.501, 0.899, 0.901)]
    brackets = spark.range(1).select(F.lit("a").alias("g"), F.array(*edges).alias("_q_x"))
    cells = p.counted(df, brackets, ["g"], wanted, True)
    rows = cells.collect()
    assert sum(r["_n"] for r in rows) == 40_000 and len(rows) < 300
    assert sorted(r["_c"] for r in rows if r["_v"] is None) == [0, 2, 4]
    plan = plan_of(cells).partition("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_approximate_is_within_its_rank_error(spark):
    df = spark.range(1001).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("x"))
    value = rows_of(p.approximate(df, ["g"], {"m": ("x", 0.5)}, accuracy=100))[0]["m"]
    assert abs(value - 500) <= p.rank_error(100, 1001)
