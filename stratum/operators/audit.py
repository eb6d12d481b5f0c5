"""Source coverage audit and warning check.

Actual coverage is one grouped aggregate per source, unioned.  The group
key is the canonical market, so the final groups are few and hot; Spark's
partial aggregation combines every task's rows before the shuffle, so each
task sends one row per (market, file) -- the distinct count is planned as a
two-level aggregate on (market, source_file) first.  The expected side is
bounded by #sources x #markets and is broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import canon_market

# Coverage status labels.
PRESENT = "present"
MISSING = "missing_expected_market"


def actual_coverage(bronze: dict[str, DataFrame]) -> DataFrame:
    """source_name, market, row_count, source_file_count over parsed bronze."""
    parts = [df.groupBy(canon_market("market").alias("market"))
             .agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct("source_file").alias("source_file_count"))
             .select(F.lit(name).alias("source_name"), "market", "row_count", "source_file_count")
             for name, df in bronze.items()]
    return reduce(DataFrame.unionByName, parts)


def coverage_state(bronze: dict[str, DataFrame]) -> DataFrame:
    """What one load adds to the coverage: rows per source, market and file.
    States of several loads merge by ``coverage_of_states``; a file that two
    loads have counts once."""
    parts = [df.groupBy(canon_market("market").alias("market"), "source_file").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("source_name"), "market", "source_file", "row_count") for name, df in bronze.items()]
    return reduce(DataFrame.unionByName, parts)


def coverage_of_states(states: DataFrame) -> DataFrame:
    """source_name, market, row_count, source_file_count from the states of
    any loads, without a look at bronze; one row per file and load is read."""
    return states.groupBy("source_name", "market").agg(F.sum("row_count").alias("row_count"), F.count_distinct("source_file").alias("source_file_count"))


def coverage_audit(bronze: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Expected source x market with observed counts and a status, ordered."""
    return audit_of(actual_coverage(bronze), expected)


def audit_of(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The audit of coverage figures, from bronze or from states."""
    e = F.broadcast(expected.select("source_name", "market"))
    joined = e.join(actual.withColumn("_seen", F.lit(True)), ["source_name", "market"], "left")
    return (joined.select("source_name", "market",
                          F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
                          F.coalesce("source_file_count", F.lit(0)).cast("bigint").alias("source_file_count"),
                          F.when(F.col("_seen").isNull(), F.lit(MISSING)).otherwise(F.lit(PRESENT))
                          .alias("coverage_status"))
            .orderBy("source_name", "market"))


def actual_markets(bronze: dict[str, DataFrame]) -> DataFrame:
    """Distinct (source_name, market) pairs seen in bronze (GROUP BY, no aggregate)."""
    parts = [df.select(F.lit(name).alias("source_name"), canon_market("market").alias("market")).distinct()
             for name, df in bronze.items()]
    return reduce(DataFrame.unionByName, parts)


def missing_coverage(bronze: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Failing rows of the warning check: expected pairs never seen."""
    return (expected.select("source_name", "market")
            .join(actual_markets(bronze), ["source_name", "market"], "left_anti"))
