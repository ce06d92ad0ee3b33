"""A pipeline over the documents: each stage applies one operator to all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import fm_index, langid, mixing, sharding, simhash
from tidemark.llm.common import cut, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return langid.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 4-word shingles, 4 bits at most."""
    return simhash.representatives(docs, length=4, most=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return fm_index.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mix of sources, each source weighted by the root of its rows."""
    return mixing.arranged(docs, mixing.tempered(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one of 16 shards."""
    return sharding.assign(docs, sharding.equal(16))


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL has no trigram likelihoods and no components over near fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
