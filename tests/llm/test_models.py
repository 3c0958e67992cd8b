"""Search, mixing and the classifier, against brute force and held-out labels."""

import collections
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest

from cabrank.llm import mixing, quality, topk
from conftest import SMALL

INF = float("inf")


def slow_top(rows, k, every):
    vectors = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((n, i, [math.floor(float(np.float32(x)) * 1024) for x in v]))
    out = []
    for n, i, q in vectors:
        if i is not None and i % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for m, j, v in vectors if m != n and len(v) == len(q)]
            out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard", "leaf"), [(10, 4), (65_536, 128)])
def test_top_k(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(topk, "LEAST_SHARD", 50)
    monkeypatch.setattr(topk.Tree.__init__, "__defaults__", (leaf,))
    rnd = random.Random(shard)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(120)]
    rows += [(500 + i, [0.5, 0.25, 0.0, -1.0]) for i in range(15)] + [(20, [1.0, 1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0, 1.0])]
    rows += [(30, None), (31, [None, 1.0, 1.0, 1.0]), (32, [INF, 0.0, 0.0, 0.0]), (33, [float("nan"), 0.0, 0.0, 0.0]), (None, [9.0] * 4),
             (40, [1.0]), (41, [2.0]), (600, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<float>, row int, v int")
    found = topk.top_k(frame, k=3, every=10, shard=shard)
    assert sorted(map(tuple, found.collect()), key=str) == slow_top(rows, 3, 10)
    assert topk.top_k(frame.limit(0)).collect() == []


def test_scores_beyond_doubles_are_exact():
    points = pd.DataFrame({"row": [0, 1, 2], "vec_id": [0, 1, 2], "known": [True] * 3, "v": [[2**40 + 1, 1], [2**40, 2], [3, 2**20 + 1]]})
    queries = pd.DataFrame({"query_row": [0], "query_id": [0], "kth": [-(2**63)], "v": [[2**20 + 1, 2**21 + 3]]})
    found = topk.search_shard(queries, points, 2)
    a, b = (2**20 + 1, 2**21 + 3), [(2**40, 2), (3, 2**20 + 1)]
    assert found["score"].tolist() == [sum(x * y for x, y in zip(a, v)) for v in b]


def sizes(rows):
    return [(i, s, len((t or "").encode().split())) for i, s, t in rows]


def slow_targets(words):
    """Share by weight, stop at the cap, share what is left again, until nothing changes."""
    names = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(words.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in rest) if rest else 0
        over = {s: 2.0 * words[s] for s in rest if weight[s] * level > 2 * words[s] * (1 + 1e-12)}
        if not over:
            return {**capped, **{s: weight[s] * level for s in rest}}
        capped |= over


def mix_rows():
    rnd = random.Random(8)
    rows = [(i, f"s{rnd.choice([0, 0, 0, 1, 2, 3, 4])}", "w " * rnd.choice([1, 5, 40, 40, 40, rnd.randrange(300)])) for i in range(900)]
    rows += [(1000 + i, "s3", "many words " * 4000) for i in range(2)]
    rows += [(None, None, "a b c"), (None, None, "a b c"), (5, "Z", None), (5, "é", "x \x0b y z"), (6, "s1", "w w"), (6, "s1", "w w")]
    return rows


@pytest.mark.parametrize("cell", [20, 50_000])
def test_mixing(spark, monkeypatch, cell):
    monkeypatch.setattr(mixing, "CELL", cell)
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, source string, text string, size string")
    found = [r.asDict() for r in mixing.taken(docs).collect()]
    words, by_size = collections.Counter(), collections.Counter()
    for i, source, text in rows:
        n = len((text or "").encode().split())
        words[source] += n
        by_size[i, n] += 1
    assert collections.Counter((r["doc_id"], r["size"]) for r in found) == by_size
    targets = slow_targets(words)
    sums = collections.defaultdict(lambda: [0, 0])
    for r in found:
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] and r["copies"] >= 0
        sums[r["source_size"], round(r["target"], 6)][0] += r["taken"]
    assert set(sums) == {(words[s], round(t, 6)) for s, t in targets.items()}
    for (size, target), (taken, _) in sums.items():
        assert abs(taken - target) <= max(3, 0.002 * size)
    again = [r.asDict() for r in mixing.taken(docs.repartition(7)).collect()]
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_rates_are_exponential_in_the_size(spark):
    cells = spark.createDataFrame([("=a", 10, 100), ("=a", 50, 20), ("=b", 5, 10), ("=c", 7, 3)], "key string, size long, n long")
    goals = spark.createDataFrame([("=a", 2000, 900.0), ("=b", 50, 75.0), ("=c", 21, 42.0)], "key string, source_size long, target double")
    found = {r.key: r for r in mixing.tilts(cells, goals).collect()}
    a = found["=a"]
    rate = [math.exp(a.tilt * s / a.mean) for s in (10, 50)]
    assert 1000 * rate[0] + 1000 * rate[1] == pytest.approx(900, rel=1e-6) and rate[1] == pytest.approx(rate[0] ** 5)
    assert math.exp(found["=b"].tilt) == pytest.approx(1.5) and math.exp(found["=c"].tilt) == pytest.approx(2)


def test_the_mix_itself(spark):
    rows = [(1, "a", "x y", "c"), (2, "a", "x", "c"), (3, "b", "", "c"), (4, "b", "p q r s", "c"), (4, "b", "p q r s", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies string")
    copies = collections.Counter(tuple(r) for r in mixing.mixture(docs).collect())
    assert set(copies) <= set(rows) and copies[rows[2]] == 1 and mixing.mixture(docs).columns == docs.columns
    assert mixing.mixture(docs.limit(0)).collect() == [] and mixing.taken(docs.limit(0)).collect() == []
    wordless = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert sorted((r.doc_id, r.target, r.taken) for r in mixing.taken(wordless).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.scored(docs, labels)
    assert found.count() == docs.count() and found.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.3)").count() == 0
    held = found.join(labels, "doc_id").where("held_out").toPandas()
    right = held["predicted"] == held["quality"]
    assert len(held) > 40 and right.mean() > 0.95 and right[held["quality"] == 0].mean() > 0.8


def test_scores_are_those_of_two_normal_densities(spark):
    """Shrunk covariances, log-determinants and Mahalanobis distances written out with numpy alone."""
    rnd = np.random.default_rng(6)
    n, size = 300, quality.SIZE
    label = (rnd.random(n) < 0.6).astype(int)
    x = rnd.normal(size=(n, size)) @ rnd.normal(size=(size, size)) + 3
    x[label == 0] = x[label == 0] * 1.7 - 1
    features = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "doc_id long, x array<double>")
    labels = spark.createDataFrame([(i, int(k)) for i, k in enumerate(label)], "doc_id long, quality int")
    model = quality.fit(features, labels, shrinkage=0.2, ridge=0.01)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    density = []
    for k in (0, 1):
        own = z[label == k]
        weight = max(0.2, size / (size + len(own)))
        covariance = (1 - weight) * np.cov(own.T, ddof=0) + weight * np.cov(z.T, ddof=0) + 0.01 * np.eye(size)
        away = z - own.mean(axis=0)
        distance = np.einsum("ij,ij->i", away, np.linalg.solve(covariance, away.T).T)
        density.append(np.log(np.mean(label == k)) - 0.5 * np.linalg.slogdet(covariance)[1] - 0.5 * distance)
    expected = 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))
    assert model.score(x) == pytest.approx(expected, abs=1e-6) and 0.02 < expected.std()


def test_long_vectors_make_more_shards(spark):
    rnd = np.random.default_rng(2)
    rows = [(i * 25, [float(v) for v in rnd.normal(size=60)]) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, topk.top_k(frame).collect()))
    assert len(whole) == 300 and sorted(map(tuple, topk.top_k(frame, shard_bytes=60 * 8 * 20).collect())) == whole


def test_sums_of_the_model():
    """Counts, sums and products of each class."""
    rnd = np.random.default_rng(1)
    rows = rnd.normal(size=(400, quality.SIZE))
    label = (rnd.random(400) < 0.7).astype(int)
    rows[label == 0] *= 2
    frame = pd.DataFrame({"label": label, "x": list(rows)})
    (sums,) = quality.moments(iter([frame]))
    total = sums.set_index(["label", "i", "j"])["value"]
    assert total[1, 0, 0] == label.sum() and total[0, 3, 0] == pytest.approx(rows[label == 0][:, 2].sum())
    assert total[1, 2, 5] == pytest.approx((rows[label == 1][:, 1] * rows[label == 1][:, 4]).sum())


def test_classifier_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", 1.0), (1, "a b c", 1.0), (None, None, 0.0), (2, "", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 7), (99, 1)], "doc_id long, quality int")
    found = quality.scored(docs, labels).collect()
    assert len(found) == 4 and {r.score for r in found} == {0.5}
    assert [r.held_out for r in found if r.doc_id is None] == [True]
    assert sorted(map(str, quality.accepted(docs, labels).collect())) == sorted(map(str, docs.collect()))
    assert quality.scored(docs.limit(0), labels).collect() == [] and quality.accepted(docs.limit(0), labels.limit(0)).collect() == []


def test_statistics_of_any_text():
    for text in (None, "", " ", "\n\n", "x" * 100_000, "é\n" * 1000, "!!!"):
        values = quality.statistics(text)
        assert len(values) == quality.SIZE and all(map(math.isfinite, values))


def test_small_tables_have_what_the_queries_need(spark):
    assert spark.read.parquet(f"{SMALL}/labels.parquet").columns == ["doc_id", "quality", "toxic"]
    assert list(itertools.islice(mixing.WEIGHTS, 3)) == [3, 1, 2]
