"""Bronze table definitions (S14) and the positional source layouts.

Fields are bound by position, exactly as the landed TSV files carry them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Source field order of the landed files (positional binding).
MATCHING_FIELDS = (
    "id_outlet", "id_platform", "platform_name", "id_ext_link", "place_id",
    "similarity_score_name", "similarity_score_address", "merged_chain_name",
    "is_chain", "num_restaurants", "serves_drinks", "serves_red_bull",
    "sugar_free_available", "organics_available", "editions_available", "ed",
    "ed_comp", "sd_coke", "sd", "leading_id_ext_link", "created_at",
)

OUTLET_FIELDS = (
    "id_ext_link", "id_outlet", "id_platform", "platform_name", "link", "name",
    "address_bulk", "business", "business_url", "delivery", "category",
    "description", "telephone", "latitude", "longitude", "num_ratings",
    "average_rating", "average_cost", "city", "icon_url", "local_icon_name",
    "min_order_amount", "banner_available", "banner_img_link", "banner_img_hash",
    "market_field", "street_address", "postal_code", "address_locality",
    "address_country", "telephone_platform", "cuisine", "website", "ghost_kitchen",
    "local_currency", "created_at", "segment_type",
)

PORTFOLIO_FIELDS = (
    "id_beverage", "id_ext_link", "id_outlet", "item_position", "item_category",
    "id_drink", "item_manufacturer", "item_brand", "item_subbrand", "item_volume",
    "item_price", "id_category", "item_drink_category_1", "item_drink_category_2",
    "item_image_url", "item_image_hash", "item_name", "item_desc", "addon_prompt",
    "addon_prompt_text", "packaging_size", "banner_available", "banner_img_link",
    "banner_img_hash", "created_at",
)

SOURCE_FIELDS = {
    "matching": MATCHING_FIELDS,
    "outlet": OUTLET_FIELDS,
    "portfolio": PORTFOLIO_FIELDS,
}

# Folder name of each source under the landing root.
SOURCE_FOLDERS = {"matching": "MATCHING", "outlet": "OUTLET", "portfolio": "PORTFOLIO"}

ROW_KEY = ("market", "source_file", "file_row_number")

METADATA_FIELDS = [
    T.StructField("market", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("file_row_number", T.LongType()),
    T.StructField("load_timestamp", T.TimestampNTZType()),
]

RAW_SCHEMA = T.StructType(METADATA_FIELDS + [T.StructField("raw_data", T.StringType())])


def payload_schema(source: str) -> T.StructType:
    """All-string positional schema of one source's data fields."""
    return T.StructType([T.StructField(f, T.StringType()) for f in SOURCE_FIELDS[source]])


def parsed_schema(source: str) -> T.StructType:
    """Bronze parsed table: 4 metadata columns + all-string payload."""
    return T.StructType(METADATA_FIELDS + payload_schema(source).fields)
