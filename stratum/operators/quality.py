"""Row classification into valid / rejected.

Rules form an ordered ladder: the first rule that fires gives the pair
(error_code, error_reason), evaluated as one CASE producing a struct so
code and reason can never disagree.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import layers

KEYS = ["market", "source_file", "file_row_number"]

# Error codes, reasons and the accepted outlet segments.
MISSING_CREATED_AT = ("MISSING_CREATED_AT", "Created_at could not be parsed from the source row.")
INVALID_SEGMENT_TYPE = ("INVALID_SEGMENT_TYPE", "Segment type is outside the currently accepted business domain.")
MISSING_ITEM_PRICE = ("MISSING_ITEM_PRICE", "Item price could not be parsed from the source row.")
ACCEPTED_SEGMENTS = ("restaurant", "grocery/convenience store/supermarket/liquor store")


@dataclass(frozen=True)
class Rule:
    code: str
    reason: str
    when: Callable[[], Column]  # built lazily so no SparkContext is needed at import
    severity: str = "reject"    # "warn": flagged in the rejected table but the row stays valid
    value_col: str | None = None  # column an allowlist entry is matched on


OUTLET_RULES = [
    Rule(*MISSING_CREATED_AT, lambda: F.col("created_at").isNull()),
    # NOT IN: a NULL segment is "unknown" and therefore not rejected.
    Rule(*INVALID_SEGMENT_TYPE, lambda: ~F.col("segment_type").isin(*ACCEPTED_SEGMENTS),
         value_col="segment_type"),
]
PORTFOLIO_RULES = [Rule(*MISSING_ITEM_PRICE, lambda: F.col("item_price").isNull())]
MATCHING_RULES = [Rule(*MISSING_CREATED_AT, lambda: F.col("created_at").isNull())]

RULES = {"outlet": OUTLET_RULES, "portfolio": PORTFOLIO_RULES, "matching": MATCHING_RULES}


def classify(staged: DataFrame, rules) -> DataFrame:
    """Add error_code / error_reason from the first firing rule (NULL if none)."""
    verdict = None
    for r in rules:
        pair = F.struct(F.lit(r.code).alias("code"), F.lit(r.reason).alias("reason"))
        verdict = F.when(r.when(), pair) if verdict is None else verdict.when(r.when(), pair)
    # one projection (each DataFrame call re-analyses the whole plan); the
    # shared CASE is evaluated once by codegen's common subexpressions
    return staged.select("*", verdict["code"].alias("error_code"), verdict["reason"].alias("error_reason"))


def rejected(staged: DataFrame, rules) -> DataFrame:
    """int_*_rejected: keys, code, reason, raw record, load time, then data."""
    data = [c for c in staged.columns if c not in KEYS + ["raw_record", "load_timestamp"]]
    return (classify(staged, rules)
            .filter(F.col("error_code").isNotNull())
            .select(*KEYS, "error_code", "error_reason", "raw_record", "load_timestamp", *data))


def valid(staged: DataFrame, rejected_rows: DataFrame) -> DataFrame:
    """int_*_valid: staged rows whose row key has no rejected row.

    Written as a left anti join, not LEFT JOIN + IS NULL (Catalyst does not
    rewrite the latter).  Semantics kept on purpose: one bad row removes
    every row sharing its key; a rejected row with a NULL key part matches
    nothing and so also stays valid.  The rejected key set is usually small
    and AQE turns the join into a broadcast at runtime; when it is not, it
    is a sort-merge anti join on three high-cardinality keys.

    Two scans, both pruned to what is read: the join itself keeps rows with a
    NULL key part, and AQE splits the partition where they gather (the left
    side of an anti join may be split)."""
    return staged.join(rejected_rows.select(*KEYS), KEYS, "left_anti").select(*staged.columns)


def split(staged: DataFrame, rules) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) for one staged source."""
    rej = rejected(staged, rules)
    return valid(staged, rej), rej


def _whole() -> Column:
    return F.expr(" and ".join(f"{k} is not null" for k in KEYS))


def met_keys(rows: DataFrame, keys: DataFrame, name: str, few: bool) -> DataFrame:
    """``_key``: hashes of the row keys of ``rows`` that ``keys`` has too,
    written.  ``few`` keys are broadcast; else a number a row is shuffled."""
    hashes = keys.filter(_whole()).select(F.xxhash64(*KEYS).alias("_key"))
    found = rows.filter(_whole()).select(F.xxhash64(*KEYS).alias("_key"))
    found = found.join(F.broadcast(hashes.distinct()) if few else hashes, "_key", "left_semi")
    return layers.materialize(found.distinct(), name)


def keys_of(keys: DataFrame, hashes: DataFrame, name: str) -> DataFrame:
    """The distinct keys with one of the hashes (``_key``), written."""
    found = keys.filter(_whole()).select(*KEYS, F.xxhash64(*KEYS).alias("_key"))
    return layers.materialize(found.join(hashes, "_key", "left_semi").select(*KEYS).distinct(), name)


def settled(staged: DataFrame, rules, name: str = "staged", earlier: DataFrame | None = None,
            now: DataFrame | None = None, few: bool = False) -> DataFrame:
    """``valid`` of a staged table of any size: the same rows, found without
    moving them.  ``earlier``: more rejected rows (their keys).  ``now``: the
    keys of this table's rejected rows where they are written already; ``few``:
    these and the earlier ones may be broadcast as hashes.

    A good row goes out only where its key also has a rejected row.  The keys
    with both are found by their hash first, in a shuffle of one number and one
    byte a row (with ``now`` of a number a row, or none), and written; the
    rejected rows are then dropped by their own verdict and the others are
    anti-joined with the (exact) rejected keys among those hashes.  Few such
    keys are broadcast and the rows stay where they are; many are joined by
    shuffle, as in ``valid``."""
    verdicts = classify(staged, rules)
    whole, bad = _whole(), F.col("error_code").isNotNull()
    out = verdicts.filter(bad).select(*KEYS) if now is None else now.select(*KEYS)
    if earlier is not None:
        out = out.unionByName(earlier.select(*KEYS))
    if now is None:
        key = F.xxhash64(*KEYS).alias("_key")
        hashed = verdicts.filter(whole).select(key, F.when(bad, F.lit(2)).otherwise(F.lit(1)).cast("tinyint").alias("_verdict"))
        if earlier is not None:
            hashed = hashed.unionByName(earlier.filter(whole).select(key, F.lit(2).cast("tinyint").alias("_verdict")))
        both = hashed.groupBy("_key").agg(F.bit_or("_verdict").alias("_verdict")).filter("_verdict = 3").select("_key")
        both = layers.materialize(both, f"doubted-{name}")
    else:
        both = met_keys(verdicts.filter(~bad), out, f"doubted-{name}", few)
    kept = verdicts.filter(~(bad & whole)).select(*staged.columns)
    if both.isEmpty():
        return kept
    return kept.join(keys_of(out, both, f"taken-{name}"), KEYS, "left_anti").select(*staged.columns)


def valid_by_filter(staged: DataFrame, rules) -> DataFrame:
    """Cheaper split, equal to ``valid`` only when row keys are unique and non-NULL."""
    return classify(staged, rules).filter(F.col("error_code").isNull()).drop("error_code", "error_reason")


def split_with_exceptions(staged: DataFrame, rules, allowlist: DataFrame | None = None
                          ) -> tuple[DataFrame, DataFrame]:
    """

    ``flagged`` is the rejected table plus ``severity`` and ``allowlisted``.
    A row is removed from the valid set only when its rule has severity
    "reject" and no allowlist entry (market, error_code, value) exempts its
    value.  The allowlist is a small curated table; AQE broadcasts it when
    its measured size allows.
    """
    sev = None
    val = None
    for r in rules:
        sev = F.when(F.col("error_code") == r.code, F.lit(r.severity)) if sev is None else \
            sev.when(F.col("error_code") == r.code, F.lit(r.severity))
        v = F.col(r.value_col).cast("string") if r.value_col else F.lit(None).cast("string")
        val = F.when(F.col("error_code") == r.code, v) if val is None else val.when(F.col("error_code") == r.code, v)
    flagged = rejected(staged, rules).select("*", sev.alias("severity"), val.alias("_value"))
    if allowlist is not None:
        allowed = allowlist.select("market", "error_code", F.col("value").alias("_value"),
                                   F.lit(True).alias("allowlisted")).distinct()
        flagged = flagged.join(allowed, ["market", "error_code", "_value"], "left")
    else:
        flagged = flagged.withColumn("allowlisted", F.lit(None).cast("boolean"))
    flagged = flagged.withColumn("allowlisted", F.coalesce("allowlisted", F.lit(False))).drop("_value")
    blocking = flagged.filter((F.col("severity") == "reject") & ~F.col("allowlisted"))
    return valid(staged, blocking), flagged
