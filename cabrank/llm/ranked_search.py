"""Ranked lexical search by the Best Position Algorithm.

Terms are the maximal runs of ASCII letters, digits and characters above U+007F, with A-Z lower-cased.
One pass over the documents counts their terms and keeps how often each holds the terms of the items.
Sums over all documents give the weight of each term and the mean length.

Documents are dealt into shards of bounded size. In a shard every term has an impact list: its documents
by falling impact. An item reads the lists of its terms side by side; a document met in one of them is
looked up in all others (direct access), and the positions it has there count as seen too. The best position of a
list is the last one up to which every position is seen. A document not seen yet adds at most the impact at the best
position of each list, and nothing where the whole list is seen; reading stops when the sum of these impacts is
strictly below the kth score, so equal scores are never lost. The shards' best k are merged.

Items are the stated query set: their terms go to every task in blocks of ``BLOCK_TERMS`` terms at most
(of one item at least), so what is sent does not grow with the documents.

Null texts hold no term. Every row of the items is an item of its own, also where ids repeat or are null; repeated
documents are ranked one after the other. Equal scores go by ascending doc_id, a null doc_id last.
An item without terms, or whose terms no document holds, and empty tables give no rows. Long
texts are split in parts of bounded length. Further columns are left alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from cabrank.llm.common import saved, text_of
from cabrank.llm.simhash import word_lists

TOP = 10
BLOCK_TERMS = 100_000
#: Entries of impact lists a shard holds on average.
SHARD_POSTINGS = 2_000_000
#: Positions read from each list in the first round; each later round reads twice as many.
STEP = 16

#: Every byte as it is in a term, or a blank.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_lists(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded length."""
    return word_lists((text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES))


def item_terms(items: DataFrame) -> DataFrame:
    """row, item_id and the distinct terms of every item that has some."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for part in term_lists(text) for t in part}) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))], ["row", "item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("row"), "item_id", text_of().alias("text"))
    return saved(rows.mapInArrow(distinct, f"row long, item_id {kind}, terms array<binary>").where(F.size("terms") > 0))


def counted(documents: DataFrame, terms: list[bytes]) -> DataFrame:
    """row, doc_id, n (all terms of the document), and of the given terms which (ids) it holds how often (times)."""
    places = {t: i for i, t in enumerate(terms)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places.get
        for batch in batches:
            lengths, ends, ids, times = [], [0], [], []
            for text in batch.column(2).to_pylist():
                n, held = 0, Counter()
                for part in term_lists(text):
                    n += len(part)
                    held.update(map(place, part))
                held.pop(None, None)
                lengths.append(n)
                ids += held.keys()
                times += held.values()
                ends.append(len(ids))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (ids, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lengths, pa.int64()), *lists], ["row", "doc_id", "n", "ids", "times"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    return saved(rows.mapInArrow(count, f"row long, doc_id {kind}, n long, ids array<long>, times array<long>"))


class Shard:
    """The impact lists of some documents, and the place of each document in them."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_docs: int):
        self.n_docs = n_docs
        by_impact = np.lexsort((docs, -impacts, terms))
        self.docs, self.impacts, terms = docs[by_impact], impacts[by_impact], terms[by_impact]
        self.names, starts = np.unique(terms, return_index=True)
        self.starts = np.append(starts, len(terms))
        position = np.arange(len(terms)) - np.repeat(starts, np.diff(self.starts))
        by_doc = np.lexsort((self.docs, terms))
        self.by_doc, self.position, self.impact_of = self.docs[by_doc], position[by_doc], self.impacts[by_doc]

    def lists(self, terms: np.ndarray) -> list[slice]:
        """Where the lists of those terms are that the shard holds."""
        at = np.searchsorted(self.names, terms)
        at = at[(at < len(self.names)) & (self.names[np.minimum(at, len(self.names) - 1)] == terms)]
        return [slice(self.starts[i], self.starts[i + 1]) for i in at]

    def best(self, terms: np.ndarray, k: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k documents with the highest scores above 0, of equal scores those that come first in ``order``, with their scores."""
        lists = self.lists(terms)
        scores, met = np.zeros(self.n_docs, np.int64), np.zeros(self.n_docs, bool)
        seen = [np.zeros(x.stop - x.start, bool) for x in lists]
        best = [0] * len(lists)
        start, step = 0, STEP
        while any(b < len(s) for b, s in zip(best, seen)):
            fresh = np.unique(np.concatenate([self.docs[x][start : start + step] for x in lists]))
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            for i, x in enumerate(lists):
                at = np.searchsorted(self.by_doc[x], fresh)
                held = at < len(seen[i])
                held[held] = self.by_doc[x][at[held]] == fresh[held]
                at = at[held]
                scores[fresh[held]] += self.impact_of[x][at]
                seen[i][self.position[x][at]] = True
                gaps = ~seen[i][best[i] :]
                best[i] = best[i] + int(gaps.argmax()) if gaps.any() else len(seen[i])
            start, step = start + step, step * 2
            # A document not met has no place up to the best position of any list.
            open_lists = [(x, b) for x, b, s in zip(lists, best, seen) if b < len(s)]
            reach = sum(int(self.impacts[x][b - 1]) if b else math.inf for x, b in open_lists)
            if np.count_nonzero(met) >= k:
                if reach < np.partition(scores[met], -k)[-k]:
                    break
        found = np.flatnonzero(met & (scores > 0))
        found = found[np.lexsort((order[found], -scores[found]))][:k]
        return found, scores[found]


def searched(weights: dict[int, int], mean: tuple[int, int], items: list[tuple[int, list[int]]], k: int):
    """The function that searches one shard for all items; ``mean`` is the number of documents and of all their terms."""
    documents, total = mean

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n = table.column("n").to_numpy()
        ids, times = (table.column(c).chunk(0) if table.column(c).num_chunks else pa.array([], pa.list_(pa.int64())) for c in ("ids", "times"))
        held = np.diff(ids.offsets.to_numpy())
        docs, terms, tf = np.repeat(np.arange(len(n)), held), ids.flatten().to_numpy(), times.flatten().to_numpy()
        m = 100 - 90 + 90 * n * documents // total
        weight = np.array([weights[t] for t in range(len(weights))], np.int64)
        impacts = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
        shard = Shard(docs, terms, impacts, len(n))
        rows = table.column("row").to_numpy()
        order = np.empty(len(n), np.int64)
        sort = [("unknown", "ascending"), ("doc_id", "ascending"), ("row", "ascending")]
        keyed = table.select(["doc_id", "row"]).append_column("unknown", table.column("doc_id").is_null())
        order[pc.sort_indices(keyed, sort_keys=sort).to_numpy()] = np.arange(len(n))
        out: list[list] = [[], [], []]
        for item, own in items:
            found, scores = shard.best(np.array(own, np.int64), k, order)
            for column, values in zip(out, ([item] * len(found), found, scores)):
                column.extend(values)
        at = pa.array(np.array(out[1], np.int64))
        return pa.table({"item": pa.array(out[0], pa.int64()), "doc_id": table.column("doc_id").take(at), "row": pa.array(rows[np.array(out[1], np.int64)]), "score": pa.array(np.array(out[2], np.int64))})

    return search


def search(documents: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The k best documents (doc_id, text) of every item (item_id, text): item_id, rank, doc_id, score."""
    listed = item_terms(items)
    spark = documents.sparkSession
    doc_kind, item_kind = (x.schema[c].dataType.simpleString() for x, c in ((documents, "doc_id"), (items, "item_id")))
    blocks = math.ceil((listed.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms)
    found = [spark.createDataFrame([], f"item long, doc_id {doc_kind}, row long, score long")]
    for block in range(blocks):
        own = listed.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "terms").collect()
        terms = sorted({bytes(t) for r in own for t in r.terms})
        if not terms:
            continue
        place = {t: i for i, t in enumerate(terms)}
        rows = counted(documents, terms)
        # How many documents hold each term: as many rows as the block has terms.
        holding = dict(map(tuple, rows.select(F.explode("ids").alias("id")).groupBy("id").count().collect()))
        n_docs, total = rows.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not holding:
            continue
        weights = {i: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(terms))}
        shards = math.ceil(sum(holding.values()) / shard_postings)
        asked = [(r.row, sorted(place[bytes(t)] for t in r.terms)) for r in own]
        dealt = rows.where(F.size("ids") > 0).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        work = searched(weights, (n_docs, total), asked, k)
        found.append(dealt.groupBy("shard").applyInArrow(work, f"item long, doc_id {doc_kind}, row long, score long"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = every.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    names = listed.select(F.col("row").alias("item"), "item_id")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
