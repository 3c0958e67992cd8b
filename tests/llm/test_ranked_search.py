"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cabrank.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def ranking(documents, items, k=10):
    held = [(key, Counter(terms_of(t))) for key, t in documents]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    result = []
    for item, text in items:
        scored = []
        for (key, c), n in zip(held, sizes):
            m = 100 - 90 + 90 * n * n_docs // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms_of(text)) if t in c
            )
            if score > 0:
                scored.append((-score, key is None, key or 0))
        for rank, (score, unknown, key) in enumerate(sorted(scored)[:k], 1):
            result.append((item, rank, None if unknown else key, -score))
    return sorted(result, key=str)


def searched(spark, documents, items, **more):
    docs = spark.createDataFrame([(*d, "x", 1) for d in documents], "doc_id long, text string, row string, shard int").repartition(3)
    asked = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, rank int")
    rows = ranked_search.search(docs, asked, **more)
    assert rows.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, rows.collect()), key=str)


def cases():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "größe", "x1", "A", "a", "日本"]
    draw = lambda n: " ".join(words[min(int(rnd.expovariate(0.1)), len(words) - 1)] for _ in range(n))
    documents = [(i, draw(rnd.randrange(1, 40))) for i in range(300)]
    documents += [(300, None), (301, ""), (302, "...!"), (None, "w1 w2 w3"), (None, "w1 w2 w3")]
    documents += [(400 + i, "w1, W2; w3-w4") for i in range(40)] + [(500, "w5 " * 30_000 + "É")]
    items = [(i, draw(rnd.randrange(1, 12))) for i in range(20)] + [(20, None), (21, "?"), (22, "unseen"), (23, "w1 w2 w3 w4"), (23, "w1 É"), (None, "w7 w7 w8")]
    return documents, items


@pytest.mark.parametrize("more", [{}, {"shard_postings": 50}, {"block_terms": 20, "shard_postings": 400}, {"k": 3}])
def test_against_all_scores(spark, more):
    documents, items = cases()
    assert searched(spark, documents, items, **more) == ranking(documents, items, more.get("k", 10))


def test_empty_tables(spark):
    documents, items = cases()
    assert searched(spark, [], items) == []
    assert searched(spark, documents, []) == []
    assert searched(spark, [(1, None), (2, "")], items) == []


def test_reading_stops_early_and_strictly_below_the_kth_score():
    rnd = np.random.default_rng(1)
    n = 5000
    docs = np.concatenate([np.arange(n)] * 3)
    terms = np.repeat([0, 1, 2], n)
    level = rnd.integers(1, 1000, n) ** 3  # the same documents are good in all lists
    impacts = np.concatenate([level * w + 1 for w in (1, 2, 3)])
    shard = ranked_search.Shard(docs, terms, impacts, n)
    reads = []
    position = shard.by_doc
    total = np.bincount(docs, impacts.astype(float), n)
    found, scores = shard.best(np.array([0, 1, 2]), 10, np.arange(n))
    expected = np.lexsort((np.arange(n), -total))[:10]
    assert found.tolist() == expected.tolist() and scores.tolist() == total[expected].astype(int).tolist()
    assert len(position) == 3 * n and not reads
    # Equal impacts everywhere: no score is below another, so all positions are read and the first in order win.
    flat = ranked_search.Shard(docs, terms, np.ones(3 * n, np.int64), n)
    order = np.arange(n)[::-1].copy()
    assert flat.best(np.array([0, 2]), 4, order)[0].tolist() == [n - 1, n - 2, n - 3, n - 4]
