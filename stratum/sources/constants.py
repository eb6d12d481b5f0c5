"""Small constant relations (S17, R1) and their data-derived forms.

The reference hard-codes three markets.  Market scope, expected coverage
and entitlements are all derived from one scope relation here, so the same
operators run on the reference's scope or on one read from data.  All of
them are bounded by (#markets x #roles), which is why they may be
broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's market scope, source names, roles.
REFERENCE_MARKETS = [("USA", "United States"), ("GBR", "United Kingdom"), ("DEU", "Germany")]
SOURCE_NAMES = ("outlet", "portfolio", "matching")
ADMIN_ROLES = ("ACCOUNTADMIN", "SYSADMIN", "SECURITYADMIN")

# Role names are our own: <prefix><MARKET><suffix>, with HQ for all markets.
ROLE_PREFIX, ROLE_SUFFIX = "MARKET_", "_ANALYST"


def role(name: str, prefix: str = ROLE_PREFIX) -> str:
    return f"{prefix}{name}{ROLE_SUFFIX}"


HQ_ROLE = role("HQ")


def reference_scope(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REFERENCE_MARKETS, "market string, market_name string")


def scope_from_regions(region: DataFrame) -> DataFrame:
    """Market scope read from a region table: code = UPPER(TRIM(name))."""
    name = F.col("r_name")
    return region.select(
        F.upper(F.trim(name)).alias("market"),
        F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2)))).alias("market_name"))


def expected_coverage(scope: DataFrame, sources=SOURCE_NAMES) -> DataFrame:
    """Every source x every market of the scope (no join: one explode)."""
    return scope.select(F.explode(F.array(*[F.lit(s) for s in sources])).alias("source_name"),
                        "market")


def market_role(market_col, prefix: str = ROLE_PREFIX) -> F.Column:
    return F.concat(F.lit(prefix), F.regexp_replace(market_col, " ", "_"), F.lit(ROLE_SUFFIX))


def entitlements(scope: DataFrame, hq_role: str = HQ_ROLE, prefix: str = ROLE_PREFIX) -> DataFrame:
    """role_name x market: each market's analyst role, plus HQ on every market."""
    return scope.select(F.explode(F.array(market_role(F.col("market"), prefix), F.lit(hq_role))).alias("role_name"),
                        "market")
