"""Per-role market row access.

``restrict`` is the row policy: a row is visible when the role is entitled
to the row's own market, or when the role is an admin role.  The
entitlement side is filtered to the one role and broadcast (bounded by the
number of markets), so the policy adds no shuffle to the protected table.
This is a view filter, not a security boundary for users who can read the
files directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.constants import ADMIN_ROLES


def restrict(df: DataFrame, entitlements: DataFrame, role: str,
             admins=ADMIN_ROLES, market_col: str = "market") -> DataFrame:
    """Rows of ``df`` the role may see (admin roles see all, unknown roles none).

    The entitlement market is compared with the row's market explicitly:
    the reference's unqualified MARKET could resolve to the entitlement
    table's own column and show every market.
    """
    if role in admins:
        return df
    allowed = (entitlements.filter(F.col("role_name") == F.lit(role))
               .select(F.col("market").alias("_ent_market")).distinct())
    return df.join(F.broadcast(allowed), F.col(market_col) == F.col("_ent_market"), "left_semi")


def restrict_all(tables: dict[str, DataFrame], entitlements: DataFrame, role: str,
                 admins=ADMIN_ROLES, register_views: bool = False) -> dict[str, DataFrame]:
    """Apply the policy to every gold relation (re-entrant: always from the
    unrestricted input).  Optionally registers ``<name>__<role>`` temp views."""
    out = {n: restrict(df, entitlements, role, admins) for n, df in tables.items()}
    if register_views:
        for n, df in out.items():
            df.createOrReplaceTempView(f"{n}__{role.lower()}")
    return out


def _roles_frame(spark: SparkSession, roles) -> DataFrame:
    if isinstance(roles, DataFrame):
        return roles.select("role_name").distinct()
    return spark.createDataFrame([(r,) for r in roles], "role_name string")


def visible_markets(df: DataFrame, entitlements: DataFrame, roles, admins=ADMIN_ROLES) -> DataFrame:
    """role_name, visible_markets (sorted distinct array) for each role.

    ``roles`` is a list or a DataFrame with ``role_name``.  Equivalent to
    ARRAY_AGG(DISTINCT market) over ``restrict(df, role)`` once per role,
    but scans ``df`` once: distinct markets first (partial aggregation
    makes that tiny), then role x market pairs from the entitlements
    (bounded by #roles x #markets) -- no per-role pass, no cross join.
    """
    spark = df.sparkSession
    markets = df.select("market").distinct()
    roles_df = _roles_frame(spark, roles)
    granted = (entitlements.select("role_name", "market")
               .join(roles_df, "role_name", "left_semi")
               .join(markets, "market"))
    admin_pairs = (markets.select(F.explode(F.array(*[F.lit(r) for r in admins])).alias("role_name"), "market")
                   .join(roles_df, "role_name", "left_semi"))
    pairs = granted.select("role_name", "market").unionByName(admin_pairs)
    agg = pairs.groupBy("role_name").agg(F.array_sort(F.collect_set("market")).alias("visible_markets"))
    return (roles_df.join(agg, "role_name", "left")
            .select("role_name", F.coalesce("visible_markets", F.array().cast("array<string>"))
                    .alias("visible_markets")))


def role_listing_counts(fact: DataFrame, entitlements: DataFrame, role: str,
                        admins=ADMIN_ROLES) -> DataFrame:
    """market, listing_count visible to the role, ordered by market."""
    return (restrict(fact.select("market"), entitlements, role, admins)
            .groupBy("market").agg(F.count(F.lit(1)).alias("listing_count"))
            .orderBy("market"))


#: The session variable that names the active role.
ROLE_VARIABLE = "active_role"


def policy_views(tables: dict[str, DataFrame], entitlements: DataFrame, admins=ADMIN_ROLES, prefix: str = "secured__") -> list[str]:
    """The policy in SQL (F17, R2, R3): one view per relation that shows what
    the session's ``active_role`` may see.  ``SET VAR active_role = '...'``
    changes what the next read of the same view returns; without a role no
    row is visible.  ``role_markets(role)`` is the entitlement as a table
    function.  Temporary objects of this session; the entitlements are a
    table of roles x markets, so the semi join broadcasts them."""
    spark = entitlements.sparkSession
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT NULL")
    entitlements.select("role_name", "market").distinct().createOrReplaceTempView(f"{prefix}entitlements")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION role_markets(active STRING) RETURNS TABLE(market STRING) "
              f"RETURN SELECT e.market FROM {prefix}entitlements e WHERE e.role_name = active")
    listed = ", ".join(f"'{a}'" for a in admins)
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}all_{name}")
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {prefix}{name} AS SELECT t.* FROM {prefix}all_{name} t WHERE {ROLE_VARIABLE} IN ({listed}) "
                  f"OR t.market IN (SELECT e.market FROM {prefix}entitlements e WHERE e.role_name = {ROLE_VARIABLE})")
        names.append(f"{prefix}{name}")
    return names
