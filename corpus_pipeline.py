"""Corpus pipeline: toxic documents go, one of each group of near duplicates
stays, copies of test items go, sources are mixed to target weights, and the
mix is dealt to shards.  Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontam, mixing, ngram_join, shards, toxicity
from stratum.llm.common import saved, small_batches
from stratum.llm.queries import table

#: SQL has no expression for fitted models, alignment and jump hashing;
#: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.keep_one(docs, k=5, least=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
