"""

All are grouped aggregates with partial aggregation before the shuffle, or
anti/semi joins; none pulls data to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canon_market
from . import dims, labels

LAYERS = ("bronze", "valid", "rejected", "gold")


def layer_counts(per_layer: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Rows per (source, market) in each layer, one column per layer.

    ``per_layer[layer][source]`` is any DataFrame with a ``market`` column.
    The pivot values are given, so no extra job discovers them.
    """
    parts = [df.groupBy(canon_market("market").alias("market")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(src).alias("source_name"), "market", F.lit(layer).alias("layer"), "n")
             for layer, by_src in per_layer.items() for src, df in by_src.items()]
    long = reduce(DataFrame.unionByName, parts)
    wide = long.groupBy("source_name", "market").pivot("layer", list(LAYERS)).agg(F.sum("n"))
    return wide.select("source_name", "market",
                       *[F.coalesce(F.col(layer), F.lit(0)).cast("bigint").alias(f"{layer}_rows")
                         for layer in LAYERS])


def reject_trend(rejected: dict[str, DataFrame], unit: str = "day") -> DataFrame:
    """Rejected rows per source, load period and error code."""
    # date_trunc yields a session-zone timestamp; back to wall-clock ntz.
    period = F.date_trunc(unit, "load_timestamp").cast("timestamp_ntz")
    parts = [df.groupBy(period.alias("load_period"), "error_code")
             .agg(F.count(F.lit(1)).alias("rejected_rows"))
             .select(F.lit(src).alias("source_name"), "load_period", "error_code", "rejected_rows")
             for src, df in rejected.items()]
    return reduce(DataFrame.unionByName, parts)


def join_coverage(valid_portfolio: DataFrame, dim_outlet: DataFrame) -> DataFrame:
    """Share of fact-eligible listings that find an outlet, per market.

    Outlet keys are made distinct first (duplicates must not inflate the
    match), then one left join and one aggregate.
    """
    listings = (valid_portfolio
                .filter(F.col("id_outlet").isNotNull() & F.col("id_beverage").isNotNull())
                .select("market", "id_ext_link"))
    keys = dim_outlet.select("market", "id_ext_link").distinct().withColumn("_hit", F.lit(1))
    j = listings.join(keys, ["market", "id_ext_link"], "left")
    return (j.groupBy("market")
            .agg(F.count(F.lit(1)).alias("listings"), F.count("_hit").alias("matched_listings"))
            .withColumn("coverage_rate", _rate("matched_listings", "listings")))


def freshness(bronze: dict[str, DataFrame], as_of, max_age_hours: float = 24.0) -> DataFrame:
    """Last load per (source, market) against an age threshold."""
    ts = F.lit(as_of).cast("timestamp_ntz")
    parts = [df.groupBy(canon_market("market").alias("market"))
             .agg(F.max("load_timestamp").alias("last_load"),
                  F.count_distinct("source_file").alias("source_files"))
             .select(F.lit(src).alias("source_name"), "market", "last_load", "source_files")
             for src, df in bronze.items()]
    out = reduce(DataFrame.unionByName, parts)
    age = F.timestamp_diff("MICROSECOND", F.col("last_load"), ts) / F.lit(3.6e9)
    return (out.withColumn("age_hours", F.round(age, 3))
            .withColumn("freshness_status",
                        F.when(F.col("age_hours") <= F.lit(max_age_hours), F.lit("fresh")).otherwise(F.lit("stale"))))


def text_hash(col="classification_text"):
    return F.sha2(F.col(col), 256)


def to_score(scoped: DataFrame, predictions: DataFrame, budget: int | None = None) -> DataFrame:
    """Rows whose (row key, text) has no prediction yet -- new or changed.

    ``budget`` caps one run (the reference's per-run spend limit); rows
    beyond it are simply picked up by the next run, in the same stable hash
    order, so nothing is ever dropped.
    """
    keys = ["market", "source_file", "file_row_number"]
    seen = predictions.select(*keys, F.unhex(text_hash()).alias("_h"))  # half the bytes of its digits
    todo = (scoped.withColumn("_h", F.unhex(text_hash()))
            .join(seen, keys + ["_h"], "left_anti").drop("_h"))
    if budget is None:
        return todo
    return todo.orderBy(*labels.sample_order(todo.columns)).limit(budget)


def review_metrics(review: DataFrame, positive: str = labels.MEAL) -> DataFrame:
    """Per market -- agreement with reviewers, precision / recall of one
    label, and the share of rows sent to review (``unclear``)."""
    pred, manual = F.col("predicted_label"), F.col("manual_review_label")
    reviewed = manual.isNotNull()
    tp = F.sum(F.when(reviewed & (pred == positive) & (manual == positive), 1).otherwise(0))
    return (review.groupBy("market")
            .agg(F.count(F.lit(1)).alias("scored_rows"),
                 F.sum(reviewed.cast("int")).alias("reviewed_rows"),
                 F.sum(F.when(reviewed & (pred == manual), 1).otherwise(0)).alias("_agree"),
                 tp.alias("_tp"),
                 F.sum(F.when(reviewed & (pred == positive), 1).otherwise(0)).alias("_pp"),
                 F.sum(F.when(reviewed & (manual == positive), 1).otherwise(0)).alias("_ap"),
                 F.sum((pred == labels.UNCLEAR).cast("int")).alias("_unclear"))
            .select("market", "scored_rows", "reviewed_rows",
                    _rate("_agree", "reviewed_rows").alias("agreement_rate"),
                    _rate("_tp", "_pp").alias("precision_positive"),
                    _rate("_tp", "_ap").alias("recall_positive"),
                    _rate("_unclear", "scored_rows").alias("review_rate")))


def _rate(num: str, den: str):
    """num / den to 6 decimals; NULL when den is 0 (ANSI-safe)."""
    return F.round(F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")) + F.lit(1e-9), 6)


def dim_history(valid_portfolio: DataFrame, attrs=("item_name", "menu_category", "has_addon_prompt")) -> DataFrame:
    """Product versions with valid_from / valid_to (SCD type 2).

    Of the listings of a product at one time, the one that ``dim_product``
    would take counts (each task keeps one per product and time before the
    shuffle).  Consecutive equal versions are one.  Undated listings are valid
    and come first, with an open start, so every product of ``dim_product``
    has a history and its current version is the one there."""
    keys = ["market", "id_beverage"]
    src = valid_portfolio.filter(F.col("id_beverage").isNotNull()).withColumn("valid_from", F.col("created_at"))
    versions = dims.latest_per_key(src, [*keys, "valid_from"], dims.product_order())
    w = Window.partitionBy(*keys).orderBy(F.col("valid_from").asc_nulls_first())
    version = F.struct(*attrs)
    changed = (versions.select(*keys, *attrs, "valid_from", version.alias("_version"))
               .withColumn("_prev", F.lag("_version").over(w)).withColumn("_row", F.row_number().over(w))
               .filter((F.col("_row") == 1) | ~F.col("_prev").eqNullSafe(F.col("_version"))))
    return (changed.withColumn("valid_to", F.lead("valid_from").over(w))
            .withColumn("is_current", F.col("valid_to").isNull())
            .select(*keys, *attrs, "valid_from", "valid_to", "is_current"))


def lineage_fingerprint(staged: DataFrame) -> DataFrame:
    """Row key + SHA-256 of the raw record carried from bronze, so a
    parsed row can be matched to its landed text without the text."""
    return staged.select("market", "source_file", "file_row_number",
                         F.sha2(F.col("raw_record"), 256).alias("raw_fingerprint"))
