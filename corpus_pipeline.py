"""From raw documents to shards: toxicity, near duplicates, benchmark leaks, mixing, sharding.

Each stage takes the rows that its predecessor kept and decides on all of them. All but
the last return the columns of documents; sharding adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from buyerscope.llm import decontamination, mixing, sharding, simhash, toxicity
from buyerscope.llm.common import table
from buyerscope.sources.staging import staged


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are predicted toxic."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.keep_civil(docs, toxicity.fit(docs, labels))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the shard of each document and its place there."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", civil),
    ("simhash near-dedup", unique),
    ("benchmark decontamination", clean),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: SQL can't express the classifier or the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
