"""Registered queries of the training-data operators, with production
parameters, over whole tables; SQL where DuckDB can express the query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, decontam, embed, licenses, line_quality, mixing, ngram_join, oracle, ranked, runs, secrets, shards, toxicity,
    warc,
)
from .common import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_secret_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, least=90)


def op4_mix_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversation_lines(*chat.tool_events(table(spark, sf_dir, "conversations")))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98, recall=1.0)


def op8_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"))


def op10_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.scan(table(spark, sf_dir, "documents"))


def op12_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


def op13_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_quality.score(docs, line_quality.fit(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (
    op1_warc_chain, op2_secret_tokens, op3_jaccard_join, op4_mix_weights, op5_decontaminate, op6_tool_calls,
    op7_multi_index, op8_toxicity_pu, op9_jump_shards, op10_license_dice, op11_periodic_runs,
    op12_max_sketch_search, op13_line_crf)}
ORACLE: dict[str, str] = {
    "op1_warc_chain": oracle.warc(),
    "op3_jaccard_join": oracle.jaccard(k=3, least=90),
    "op4_mix_weights": oracle.mix(),
    "op7_multi_index": oracle.near_vectors(least=0.98),
    "op10_license_dice": oracle.licences(licenses.TEMPLATES),
    "op11_periodic_runs": oracle.periodic_runs(),
    "op12_max_sketch_search": oracle.ranked(),
}
