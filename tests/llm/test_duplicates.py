"""Exact and near duplicates and the components below them, against brute force."""

import collections
import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from cabrank.llm import components, exact_dedup, simhash

DOCS = "doc_id long, text string, digest int, row string"


def documents(spark, rows):
    """Extra columns have the names that the operators use themselves."""
    return spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], DOCS)


MIXED = [(5, "a b"), (7, "a b"), (6, "a b"), (1, ""), (2, None), (3, "A b"), (None, "z"), (9, "z"), (None, "q"), (None, "q"),
         (4, "dup"), (4, "dup"), (8, "ß\n x" * 5000), (10, "ß\n x" * 5000)]


def settled(rows):
    """doc_id, keep_id, size and digest of every row, and how many rows of each group stay."""
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return expected, groups


@pytest.mark.parametrize("counters", [1, 3, 256])
def test_exact_duplicates(spark, counters):
    rows = exact_dedup.decisions(documents(spark, MIXED), counters).withColumn("digest", F.lower(F.hex("digest"))).collect()
    expected, groups = settled(MIXED)
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.digest) for r in rows], key=key) == sorted(expected, key=key)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("counters", [1, 256])
def test_one_document_of_each_text_stays_with_its_columns(spark, counters):
    docs = documents(spark, MIXED)
    kept = exact_dedup.keep_one(docs, counters)
    assert kept.columns == docs.columns
    expected, groups = settled(MIXED)
    assert sorted(((r.text or "", r.doc_id) for r in kept.collect()), key=str) == sorted(
        ((t, max((i for i in ids if i is not None), default=None)) for t, ids in groups.items()), key=str
    )


def test_summaries_miss_no_frequent_digest():
    import pyarrow as pa

    rnd = random.Random(3)
    rows = [bytes([rnd.choice([1, 1, 1, 2, 2, rnd.randrange(200)])]) for _ in range(5000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + 700], pa.binary())], ["digest"]) for i in range(0, 5000, 700)]
    (held,) = exact_dedup.summarise(iter(batches), 4)
    held = dict(zip(held.column(0).to_pylist(), held.column(1).to_pylist()))
    true = collections.Counter(rows)
    assert len(held) <= 4
    for digest, n in true.items():
        assert n - len(rows) / 5 <= held.get(digest, 0) <= n


@pytest.mark.parametrize("call", [exact_dedup.decisions, exact_dedup.keep_one, simhash.near_duplicates, simhash.keep_one])
def test_empty_table(spark, call):
    assert call(documents(spark, [])).collect() == []


def union_find(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rnd = random.Random(shape)
    pairs = {
        "random": [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(100)],
        "star": [(50, i) for i in range(120)] + [(50, 50)],
        "none": [],
    }[shape]
    rnd.shuffle(pairs)
    found = components.connected(spark.createDataFrame(pairs, "x long, y long"))
    assert {r.node: r.root for r in found.collect()} == {x: r for x, r in union_find(pairs).items() if x != r}


def slow_fingerprint(text):
    table = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words, word = [], ""
    for c in (text or "").translate(table) + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or [words] * bool(words)
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = ["", None, " \n", "One", "ONE two", "one Two\tthree", "É one\x0btwo three \x1c x", "a b c d e f " * 50, "\x85 a\xa0b c d"]


@pytest.mark.parametrize("part", [1, 7, 1 << 20])
def test_fingerprints(monkeypatch, part):
    monkeypatch.setattr(simhash.word_lists, "__defaults__", (part,))
    assert [simhash.fingerprint(t) for t in TEXTS] == [slow_fingerprint(t) for t in TEXTS]


def test_shingle_hashes_are_those_of_spark(spark):
    value = spark.sql("SELECT xxhash64('one two three')").first()[0]
    assert value % 2**64 == simhash.fingerprint("one TWO three")


def near(x, y):
    return (x ^ y).bit_count() <= 2


@pytest.mark.parametrize("crowd", [1, 4, 32])
def test_every_link_is_found(spark, crowd):
    """A dense cloud around a few centres, with many members in a bucket."""
    rnd = random.Random(crowd)
    centres = [rnd.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]
    prints = list({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(5))) for c in centres for _ in range(25)})
    rows = [(p - 2**64 if p >> 63 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(rows, "fp long"), crowd=crowd).collect()
    signed = sorted(r[0] for r in rows)
    expected = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if near(a % 2**64, b % 2**64)}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_near_duplicates(spark):
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "one"), (None, "lonely words here"), (3, "ONE")]
    for i in range(100, 160):
        if i % 3:
            text = rows[-1][1].split()
            text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        else:
            text = rnd.choices(vocabulary, k=400)
        rows.append((i, " ".join(text)))
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = union_find([(a, b) for a in range(len(rows)) for b in range(a, len(rows)) if near(prints[a], prints[b])])
    groups = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[roots[k]].append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    docs = documents(spark, rows)
    found = simhash.near_duplicates(docs).collect()
    expected = [(i, prints[k], least[roots[k]]) for k, (i, _) in enumerate(rows)]
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=str) == sorted(expected, key=str)
    assert any(len(ids) > 1 for ids in groups.values())
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(least.values(), key=str)


def test_only_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "x"), (None, "x")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect()), key=str) == [(1, "same text here"), (None, "x")]
