"""The corpus pipeline: documents in, a sharded training mix out.

Each stage takes what the one before it kept: toxic documents go, one document of each group of
near duplicates stays, documents with benchmark passages go, sources are mixed to their weights
(a document may appear twice), and the rows are dealt to shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkledger.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from inkledger.llm.common import load, staged
from inkledger.llm.queries import MIX_WEIGHTS, SHARDS, learnable, row_hash


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below one half."""
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), learn=learnable())
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by five-word shingles."""
    return near_dedup.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``."""
    return decontaminate.decontaminated(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    return mixing.repeated(mixing.mix(docs, "source", mixing.word_count(F.col("text")), row_hash(), MIX_WEIGHTS))


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their place in the shuffle: row number, shard and slot."""
    return sharding.shard_rows(docs, [F.col("doc_id"), F.xxhash64("text")], SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: Fitting a classifier and hashed signatures have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
