"""Deterministic, null-safe surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key recipe: md5 over '-'-joined text parts, a NULL part replaced by a
# sentinel (null-safe, order-sensitive).  The reference pins the recipe
# but not its body, so the digest values are ours; Spark and the SQL twin
# below produce identical digests.
KEY_SEPARATOR = "-"
NULL_SENTINEL = "_null_key_part_"


def surrogate_key(*cols, sentinel: str = NULL_SENTINEL) -> Column:
    """md5 hex over the parts; order-sensitive, never NULL.

    Pure column expression: stays inside whole-stage codegen.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(sentinel))
             for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def surrogate_key_sql(*exprs: str, sentinel: str = NULL_SENTINEL) -> str:
    """The same key as ANSI SQL text (used for oracle queries)."""
    parts = ", ".join(f"coalesce(cast({e} as varchar), '{sentinel}')" for e in exprs)
    return f"md5(concat_ws('{KEY_SEPARATOR}', {parts}))"
