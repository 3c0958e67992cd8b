"""The registered queries against SQL or brute force, and the pipeline stage by stage."""

import collections
import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cabrank.llm import bpe, queries
from conftest import SMALL
from test_duplicates import near, slow_fingerprint, union_find
from test_models import slow_targets
from test_near_copies import expected as similar_groups
from test_registry import table

TABLES = ("documents", "pages", "embeddings", "labels", "benchmark", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def library():
    ranks = bpe.codec(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_all_are_registered():
    found = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(found) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, duck, name):
    result = queries.QUERIES[name](spark, SMALL)
    expected = duck.sql(queries.ORACLE[name])
    types = {"string": "varchar", "int": "integer"}
    assert {n: types.get(t, t) for n, t in result.dtypes} == {n: str(t).lower() for n, t in zip(expected.columns, expected.types)}
    assert table(result.columns, result.collect()) == table(expected.columns, expected.fetchall())


def digests(library, text):
    ids = library.encode_ordinary(text)
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_encoding_query(spark, duck, library):
    texts = dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    found = {r.doc_id: tuple(r)[1:] for r in queries.op3_byte_bpe(spark, SMALL).collect()}
    assert found == {i: digests(library, t) for i, t in texts.items()}


def test_simhash_query(spark, duck):
    rows = sorted(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    prints = [slow_fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a, len(rows)) if near(prints[a], prints[b])]
    roots = union_find(pairs)
    expected = [(i, f"{prints[k]:016x}", rows[roots[k]][0]) for k, (i, _) in enumerate(rows)]
    assert sorted(map(tuple, queries.op8_simhash(spark, SMALL).collect())) == expected


def test_token_count_query(spark, duck):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    expected = []
    for i, text in duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        n = len(tokenizer.encode(text, add_special_tokens=False))
        expected.append((i, len(text.encode()), n, n > 1024))
    assert sorted(map(tuple, queries.op6_token_counts(spark, SMALL).collect())) == sorted(expected)


def test_mixing_query(spark, duck):
    sizes = {i: (source, len((text or "").encode().split())) for i, source, text in duck.sql("SELECT doc_id, source, text FROM documents").fetchall()}
    words = collections.Counter()
    for source, n in sizes.values():
        words[source] += n
    targets, taken = slow_targets(words), collections.Counter()
    rows = queries.op7_source_mixing(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(sizes)
    for r in rows:
        source, n = sizes[r.doc_id]
        assert (r["size"], r.source_size) == (n, words[source]) and r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * n
        taken[source] += r.taken
    assert all(abs(taken[s] - t) <= max(50, 0.02 * words[s]) for s, t in targets.items())


CLASHING = ["content", "digest", "keep_id", "score", "node", "root", "row", "place", "copies", "size", "keys", "order", "frequent"]


def test_stages_on_empty_tables_and_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    few = docs.where("doc_id % 9 = 0").withColumns({name: F.lit(name) for name in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SMALL).collect() == [] and stage(spark, docs.limit(0), SMALL).columns == docs.columns
        kept = stage(spark, few, SMALL)
        rows = kept.collect()
        assert kept.columns == few.columns and rows and all(r[c] == c for r in rows for c in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SMALL).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, few, SMALL).count() == few.count()


def test_pipeline(spark, duck, library):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe",
    ]
    stages = [f for _, f in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = stages[0](spark, docs, SMALL).persist()
    assert kept.columns == columns
    accepted = {r.doc_id for r in queries.op10_quality(spark, SMALL).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == accepted and 0 < len(accepted) < docs.count()

    single = stages[1](spark, kept, SMALL).persist()
    best = {}
    for r in kept.collect():
        best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(best.values())

    apart = stages[2](spark, single, SMALL).persist()
    rows = sorted((r.doc_id, r.text) for r in single.collect())
    assert apart.columns == columns and sorted(r.doc_id for r in apart.collect()) == similar_groups(rows)[0]

    mixed = stages[3](spark, apart, SMALL).persist()
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and set(copies) <= {r.doc_id for r in apart.collect()} and set(copies.values()) <= {1, 2}

    result = stages[4](spark, mixed, SMALL).collect()
    texts = {r.doc_id: r.text for r in apart.collect()}
    assert collections.Counter(r.doc_id for r in result) == copies
    for r in result[:200]:
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, texts[r.doc_id])
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in result)
