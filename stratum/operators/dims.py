"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (ROW_NUMBER() = 1).

    Catalyst plans ``row_number() = 1`` as a WindowGroupLimit: each task
    keeps one row per key before the shuffle, so a hot key costs one row
    per task in the exchange, not all its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_row_num", F.row_number().over(w))
            .filter(F.col("_row_num") == 1)
            .drop("_row_num"))


def dim_market(scope: DataFrame) -> DataFrame:
    """dim_market from a market scope relation (market, market_name)."""
    return scope.select(surrogate_key("market").alias("market_key"), "market", "market_name")


#: What ``dim_platform`` reads.
PLATFORM_COLUMNS = ["market", "id_platform", "platform_name", "load_timestamp", "source_file", "file_row_number"]


def dim_platform(valid_outlets: DataFrame) -> DataFrame:
    """Latest platform name per (market, id_platform) among valid outlets.

    Order: load_timestamp DESC, platform_name ASC (NULLs last), then the
    row key so that every tie is decided.
    """
    src = (valid_outlets.filter(F.col("id_platform").isNotNull())
           .select(*PLATFORM_COLUMNS))
    latest = latest_per_key(src, ["market", "id_platform"], [
        F.col("load_timestamp").desc_nulls_first(), F.col("platform_name").asc_nulls_last(),
        F.col("source_file").asc_nulls_last(), F.col("file_row_number").asc_nulls_last()])
    return latest.select(surrogate_key("market", "id_platform").alias("platform_key"),
                         surrogate_key("market").alias("market_key"),
                         "market", "id_platform", "platform_name")


_SIGNAL_FLAGS = ["serves_drinks", "serves_red_bull", "sugar_free_available",
                 "organics_available", "editions_available", "is_chain"]


#: What ``matching_signals`` reads.
SIGNAL_COLUMNS = ["market", "id_outlet", *_SIGNAL_FLAGS, "num_restaurants", "similarity_score_name", "similarity_score_address"]


def matching_signals(valid_matching: DataFrame) -> DataFrame:
    """Per (market, id_outlet): OR of flags, max restaurants, mean scores.

    Hash aggregate with map-side partial aggregation, so a hot outlet is
    pre-combined in every task before the shuffle.
    """
    return (valid_matching.filter(F.col("id_outlet").isNotNull())
            .groupBy("market", "id_outlet")
            .agg(*[F.max(f).alias(f) for f in _SIGNAL_FLAGS],
                 F.max("num_restaurants").alias("num_restaurants"),
                 F.avg("similarity_score_name").alias("avg_similarity_score_name"),
                 F.avg("similarity_score_address").alias("avg_similarity_score_address")))


OUTLET_COLUMNS = ["market", "id_outlet", "id_ext_link", "id_platform", "platform_name",
                "name", "business_name", "primary_category", "segment_type", "latitude",
                "longitude", "city", "street_address", "postal_code", "address_state_locality",
                "address_country", "num_ratings", "average_rating", "delivery_fee",
                "min_order_amount", "local_currency", "is_banner_available", "is_ghost_kitchen",
                "created_at", "link", "website"]


def dim_outlet(valid_outlets: DataFrame, valid_matching: DataFrame) -> DataFrame:
    """One row per valid outlet-platform row (not deduplicated, by intent),
    enriched with its outlet's matching signals (flags default FALSE)."""
    outlets = valid_outlets.filter(F.col("id_outlet").isNotNull()).select(*OUTLET_COLUMNS)
    m = matching_signals(valid_matching)
    joined = outlets.join(m, ["market", "id_outlet"], "left")
    body = [c if c != "name" else F.col("name").alias("outlet_name") for c in OUTLET_COLUMNS]
    body += [F.coalesce(F.col(f), F.lit(False)).alias(f) for f in _SIGNAL_FLAGS]
    body += ["num_restaurants", "avg_similarity_score_name", "avg_similarity_score_address"]
    return joined.select(surrogate_key("market", "id_ext_link").alias("outlet_key"),
                         surrogate_key("market").alias("market_key"),
                         surrogate_key("market", "id_platform").alias("platform_key"),
                         *body)


PRODUCT_COLS = ["market", "id_beverage", "id_drink", "id_category", "item_name", "item_brand",
                 "item_subbrand", "item_manufacturer", "menu_category", "drink_category_primary",
                 "drink_category_secondary", "item_description", "item_volume_ml",
                 "packaging_size", "item_image_url", "has_addon_prompt", "addon_text",
                 "created_at"]


def product_order() -> list[Column]:
    """created_at DESC NULLS LAST, load_timestamp DESC, the row key, then the
    row content (a row key can repeat), so no tie is left open."""
    return [F.col("created_at").desc_nulls_last(), F.col("load_timestamp").desc_nulls_first(),
            F.col("source_file").asc_nulls_last(), F.col("file_row_number").asc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in PRODUCT_COLS[2:]]]


#: What orders the listings of a product and isn't in the dimension.
PRODUCT_ORDER_COLS = ["load_timestamp", "source_file", "file_row_number"]


def product_listings(valid_portfolio: DataFrame) -> DataFrame:
    """Listings that may describe a product: its columns and their order's."""
    return valid_portfolio.filter(F.col("id_beverage").isNotNull()).select(*PRODUCT_COLS, *PRODUCT_ORDER_COLS)


def product_rows(listings: DataFrame, *more: str) -> DataFrame:
    """dim_product's row of each of the (latest) listings."""
    return listings.select(surrogate_key("market", "id_beverage").alias("product_key"),
                           surrogate_key("market").alias("market_key"), *PRODUCT_COLS, *more)


def dim_product(valid_portfolio: DataFrame) -> DataFrame:
    """Latest listing attributes per (market, id_beverage).

    Order: created_at DESC NULLS LAST, load_timestamp DESC, then the row
    key ascending (the reference leaves such ties undecided).
    """
    return product_rows(latest_per_key(product_listings(valid_portfolio), ["market", "id_beverage"], product_order()))


_DRINK_COLS = ["market", "id_drink", "item_brand", "item_subbrand", "item_manufacturer",
               "drink_category_primary", "drink_category_secondary"]


def dim_drink(valid_portfolio: DataFrame) -> DataFrame:
    """Drink-level dimension (one row per market and id_drink): the latest
    brand and category attributes, ordered like dim_product."""
    src = (valid_portfolio.filter(F.col("id_drink").isNotNull())
           .select(*_DRINK_COLS, "created_at", "load_timestamp", "source_file", "file_row_number"))
    latest = latest_per_key(src, ["market", "id_drink"], [
        F.col("created_at").desc_nulls_last(), F.col("load_timestamp").desc_nulls_first(),
        F.col("source_file").asc_nulls_last(), F.col("file_row_number").asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in _DRINK_COLS[2:]]])
    return latest.select(surrogate_key("market", "id_drink").alias("drink_key"),
                         surrogate_key("market").alias("market_key"), *_DRINK_COLS)


def bridge_beverage_drink(valid_portfolio: DataFrame) -> DataFrame:
    """Beverage (size variant) -> drink bridge: distinct pairs seen in listings,
    with how many listings carry each pair (a beverage may map to several drinks)."""
    return (valid_portfolio.filter(F.col("id_beverage").isNotNull() & F.col("id_drink").isNotNull())
            .groupBy("market", "id_beverage", "id_drink").agg(F.count(F.lit(1)).alias("listings"))
            .select(surrogate_key("market", "id_beverage").alias("product_key"),
                    surrogate_key("market", "id_drink").alias("drink_key"),
                    "market", "id_beverage", "id_drink", "listings"))
