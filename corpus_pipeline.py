"""From raw documents to token ids: quality, exact and near duplicates, the mix of sources, encoding."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cabrank.llm import bpe, exact_dedup, mixing, near_copies as near_copies_of, quality
from cabrank.llm.common import saved, table
from cabrank.llm.queries import RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the classifier accepts; it learns from the labelled ones among those it is given."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash components and minimum hashes, checked by five-word shingles 0.8 alike."""
    return near_copies_of.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixture(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix, with the digest of the bytes they decode to."""
    return bpe.encoded_and_checked(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", mixed_sources),
    ("byte_bpe", encoded),
]

#: Training, similarity components and encoding have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is kept in the shared folder before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
