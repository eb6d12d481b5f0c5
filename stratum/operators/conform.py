"""Silver staging (M1-M3): type, rename and flag bronze rows, keep lineage.

Each source is described by a spec: ordered (output column, conversion,
bronze column).  ``conform`` turns the spec into one projection, so the
whole staging step is a single codegen'd Project over the scan and parquet
column pruning keeps only what downstream actually reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import flag_one, flag_true, safe_double, safe_number, safe_timestamp
from ..functions.text import alnum_lower, canon_market

KEYS = ["market", "source_file", "file_row_number"]

_CONVERT = {
    "text": lambda c: F.col(c),
    "double": safe_double,
    "number": safe_number,
    "timestamp": safe_timestamp,
    "flag1": flag_one,
    "flag_true": flag_true,
    "alnum_lower": alnum_lower,
}

# (output, conversion, bronze column) in output order.
OUTLET_SPEC = [
    ("id_ext_link", "text", "id_ext_link"),
    ("id_outlet", "text", "id_outlet"),
    ("id_platform", "text", "id_platform"),
    ("platform_name", "text", "platform_name"),  # not normalised for outlets
    ("name", "text", "name"),
    ("business_name", "text", "business"),
    ("primary_category", "text", "category"),
    ("segment_type", "text", "segment_type"),
    ("latitude", "double", "latitude"),
    ("longitude", "double", "longitude"),
    ("city", "text", "city"),
    ("street_address", "text", "street_address"),
    ("postal_code", "text", "postal_code"),
    ("address_state_locality", "text", "address_locality"),
    ("address_country", "text", "address_country"),
    ("num_ratings", "number", "num_ratings"),
    ("average_rating", "double", "average_rating"),
    ("delivery_fee", "double", "delivery"),
    ("min_order_amount", "double", "min_order_amount"),
    ("local_currency", "text", "local_currency"),
    ("is_banner_available", "flag_true", "banner_available"),
    ("is_ghost_kitchen", "flag1", "ghost_kitchen"),
    ("created_at", "timestamp", "created_at"),
    ("link", "text", "link"),
    ("website", "text", "website"),
]

PORTFOLIO_SPEC = [
    ("id_beverage", "text", "id_beverage"),
    ("id_ext_link", "text", "id_ext_link"),
    ("id_outlet", "text", "id_outlet"),
    ("id_drink", "text", "id_drink"),
    ("id_category", "text", "id_category"),
    ("item_name", "text", "item_name"),
    ("item_brand", "text", "item_brand"),
    ("item_subbrand", "text", "item_subbrand"),
    ("item_manufacturer", "text", "item_manufacturer"),
    ("menu_category", "text", "item_category"),
    ("drink_category_primary", "text", "item_drink_category_1"),
    ("drink_category_secondary", "text", "item_drink_category_2"),
    ("item_description", "text", "item_desc"),
    ("item_volume_ml", "double", "item_volume"),
    ("item_price", "double", "item_price"),
    ("item_position_code", "text", "item_position"),
    ("packaging_size", "text", "packaging_size"),
    ("is_banner_available", "flag_true", "banner_available"),
    ("has_addon_prompt", "flag1", "addon_prompt"),
    ("addon_text", "text", "addon_prompt_text"),
    ("item_image_url", "text", "item_image_url"),
    ("created_at", "timestamp", "created_at"),
]

MATCHING_SPEC = [
    ("id_outlet", "text", "id_outlet"),
    ("id_platform", "text", "id_platform"),
    ("platform_name", "alnum_lower", "platform_name"),  # normalised for matching
    ("id_ext_link", "text", "id_ext_link"),
    ("place_id", "text", "place_id"),
    ("similarity_score_name", "double", "similarity_score_name"),
    ("similarity_score_address", "double", "similarity_score_address"),
    ("merged_chain_name", "text", "merged_chain_name"),
    ("is_chain", "flag1", "is_chain"),
    ("serves_drinks", "flag1", "serves_drinks"),
    ("serves_red_bull", "flag1", "serves_red_bull"),
    ("sugar_free_available", "flag1", "sugar_free_available"),
    ("organics_available", "flag1", "organics_available"),
    ("editions_available", "flag1", "editions_available"),
    ("num_restaurants", "number", "num_restaurants"),
    ("ed", "number", "ed"),
    ("ed_comp", "number", "ed_comp"),
    ("sd_coke", "number", "sd_coke"),
    ("sd", "number", "sd"),
    ("leading_id_ext_link", "text", "leading_id_ext_link"),
    ("created_at", "timestamp", "created_at"),
]

SPECS = {"outlet": OUTLET_SPEC, "portfolio": PORTFOLIO_SPEC, "matching": MATCHING_SPEC}


def attach_raw(parsed: DataFrame, raw: DataFrame) -> DataFrame:
    """Parsed LEFT JOIN raw on the canonical row key -> ``raw_record``.

    Market is canonicalised on both sides before the join.  The join is on
    three high-cardinality keys, so it never collapses onto few markets.
    Duplicate raw keys fan out, exactly like the SQL left join.
    """
    r = raw.select(canon_market("market").alias("market"), "source_file", "file_row_number",
                   F.col("raw_data").alias("raw_record"))
    p = parsed.withColumn("market", canon_market("market"))
    return p.join(r, KEYS, "left")


def conform(parsed: DataFrame, spec, raw: DataFrame | None = None) -> DataFrame:
    """Bronze parsed rows -> typed staging rows.

    ``raw`` given: lineage comes from the raw table (J1).  Otherwise a
    ``raw_data`` column carried from the same scan is used, or NULL.
    """
    if raw is not None:
        base = attach_raw(parsed.drop("raw_data") if "raw_data" in parsed.columns else parsed, raw)
        raw_col = F.col("raw_record")
    else:
        base = parsed.withColumn("market", canon_market("market"))
        raw_col = F.col("raw_data") if "raw_data" in parsed.columns else F.lit(None).cast("string")
    cols = [F.col(k) for k in KEYS]
    cols += [_CONVERT[kind](src).alias(out) for out, kind, src in spec]
    cols += [raw_col.alias("raw_record"), F.col("load_timestamp")]
    return base.select(*cols)


def stg_outlets(parsed: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    return conform(parsed, OUTLET_SPEC, raw)


def stg_portfolio(parsed: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    return conform(parsed, PORTFOLIO_SPEC, raw)


def stg_matching(parsed: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    return conform(parsed, MATCHING_SPEC, raw)


STAGERS = {"outlet": stg_outlets, "portfolio": stg_portfolio, "matching": stg_matching}
