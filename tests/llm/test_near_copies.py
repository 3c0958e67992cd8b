"""The near-copy stage of the pipeline against brute-force Jaccard over five-word shingles."""

import collections
import random

import pytest

import corpus_pipeline
from cabrank.llm import near_copies, simhash
from conftest import SMALL
from test_duplicates import union_find


def words_of(text):
    table = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return (text or "").translate(table).encode().split()


def slow_shingles(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def expected(rows):
    """The smallest doc_id of each component, and the number of components with several texts."""
    sets = [slow_shingles(t) for _, t in rows]
    alike = [
        (a, b)
        for a in range(len(rows))
        for b in range(a, len(rows))
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    groups = collections.defaultdict(list)
    for k, r in union_find(alike).items():
        groups[r].append(rows[k][0])
    return sorted(min(ids) for ids in groups.values()), len(groups)


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return words


def cases(seed):
    rnd = random.Random(seed)
    rows = ["", None, " \n", "One", "ONE two", "one Two", "a b c d", "a b c d e", "A b\tc d E", "a b c d e f"]
    for _ in range(30):
        base = [f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(40, 300))]
        rows.append(" ".join(base))
        for n in (1, len(base) // 45, len(base) // 30):
            rows.append(" ".join(edited(rnd, base, n)))
    crowd = [f"c{i}" for i in range(150)]
    rows += [" ".join(edited(rnd, crowd, rnd.randrange(9))) for _ in range(120)]
    # Copies far from the text that most resemble, in chains and beside a passage that all of them share.
    for _ in range(12):
        words = crowd
        for _ in range(5):
            words = edited(rnd, words, 2)
            rows.append(" ".join(words))
    for _ in range(25):
        own = [f"o{rnd.randrange(10**6)}" for _ in range(rnd.choice([20, 60]))]
        rows += [" ".join(crowd[:90] + edited(rnd, own, n)) for n in (0, 2)]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [5, 6])
def test_stage_against_brute_force(spark, seed):
    rows = cases(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ids, n = expected(rows)
    assert 30 < n < len(rows) - 100
    kept = corpus_pipeline.near_copies(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == ids


def test_stage_on_the_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()) == expected(rows)[0]


def test_other_shingle_and_similarity(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c e"), (3, "x y z"), (None, "x y z"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in near_copies.keep_one(docs, 1, 0.6).collect() if r.text) == [(1, "a b c d"), (3, "x y z")]
    assert near_copies.keep_one(docs).count() == 4
    assert near_copies.keep_one(docs.limit(0)).collect() == []


def test_simhash_components_are_buckets(spark):
    """Texts of one SimHash component meet without any minimum hash in common, and only alike ones are linked."""
    rnd = random.Random(8)
    phrase = "to be or " * 100
    texts = [phrase + " ".join(f"{p}{i}" for i in range(40)) for p in "xy"]
    for _ in range(6):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(base), " ".join([*base, "more"]), " ".join(edited(rnd, base, 1))]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [simhash.fingerprint(t) for t in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= simhash.DISTANCE]
    sets = [slow_shingles(t) for t in texts]
    alike = [(a, b) for a, b in near if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert (1, 0) in near and (1, 0) not in alike and len(alike) > 6

    unlike = near_copies.F.array(near_copies.F.xxhash64("doc_id"))  # in place of minimum hashes
    named = docs.select("doc_id", near_copies._node().alias("node"), simhash.fingerprints("text").alias("fp"), unlike.alias("keys"))
    roots = {bytes(r.node): bytes(r.root) for r in near_copies.connected(near_copies.links(docs, near_copies.with_prints(named))).collect()}
    found = {r.doc_id: roots.get(bytes(r.node), bytes(r.node)) for r in named.collect()}
    of = union_find([(k, k) for k in range(len(texts))] + alike)
    assert all((of[a] == of[b]) == (found[a] == found[b]) for a in of for b in of)
