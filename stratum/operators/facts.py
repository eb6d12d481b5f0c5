"""Gold fact: outlet-product listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..sources import layers

LISTING_COLUMNS = ["market", "source_file", "file_row_number", "id_outlet", "id_beverage",
                   "id_ext_link", "item_name", "item_price", "item_volume_ml", "item_position_code",
                   "menu_category", "is_banner_available", "has_addon_prompt", "created_at",
                   "load_timestamp"]

FACT_COLUMNS = ["listing_key", "market_key", "platform_key", "outlet_key", "product_key",
                "market", "source_file", "file_row_number", "id_outlet", "id_beverage",
                "id_ext_link", "item_name", "item_price", "item_volume_ml", "item_position_code",
                "menu_category", "is_banner_available", "has_addon_prompt", "serves_red_bull",
                "serves_drinks", "is_chain", "outlet_average_rating", "outlet_num_ratings",
                "delivery_fee", "min_order_amount", "created_at", "load_timestamp"]


#: Pieces of a hot link per task's share of the listings.
PIECES = 4


def hot_links(listings: DataFrame, parts: int) -> DataFrame:
    """market, id_ext_link, _pieces of links that hold more than one of
    ``parts`` shares of all listings, at most ``parts`` rows.  Counted by a
    sketch in one pass over two columns: a link missed or too many changes
    how rows are dealt, never the result."""
    link = "named_struct('market', market, 'id_ext_link', id_ext_link)"
    top = listings.filter("market is not null and id_ext_link is not null").agg(
        F.count(F.lit(1)).alias("_n"), F.expr(f"approx_top_k(to_json({link}), {parts}, {max(1024, 8 * parts)})").alias("_top"))
    item = F.from_json("_hot.item", "market string, id_ext_link string")
    return (top.select("_n", F.explode("_top").alias("_hot"))
            .select(item["market"].alias("market"), item["id_ext_link"].alias("id_ext_link"),
                    F.ceil(F.col("_hot.count") * parts * PIECES / F.col("_n")).cast("int").alias("_pieces"))
            .filter(F.col("_pieces") > PIECES))


def join_spread(listings: DataFrame, outlets: DataFrame, parts: int) -> DataFrame:
    """The inner join on (market, id_ext_link) with hot links dealt in pieces:
    a listing goes to the piece its content hashes to (the same after a
    retry), the link's outlets to all of them.  Needed where a hot link's
    listings each meet many outlets: AQE splits by bytes read, not by rows made.
    The hot links are counted when the join is built and written, so that both
    sides are dealt by the same numbers; without any it is the plain join."""
    link, hot = ["market", "id_ext_link"], layers.materialize(hot_links(listings, parts), "hot-links")
    if hot.isEmpty():
        return listings.join(outlets, link)
    # only a hot link's listings are hashed
    piece = F.when(F.col("_pieces").isNotNull(), F.pmod(F.xxhash64(*listings.columns), F.col("_pieces"))).otherwise(F.lit(0))
    dealt = listings.join(F.broadcast(hot), link, "left").withColumn("_piece", piece.cast("int"))
    copied = outlets.join(F.broadcast(hot), link, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
    return dealt.drop("_pieces").join(copied.drop("_pieces"), [*link, "_piece"]).drop("_piece")


#: What the fact reads of an outlet.
OUTLET_COLUMNS = ["market", "id_ext_link", "platform_key", "outlet_key", "serves_red_bull", "serves_drinks", "is_chain",
                  "average_rating", "num_ratings", "delivery_fee", "min_order_amount"]


def outlet_columns(dim_outlet: DataFrame, *more: str) -> DataFrame:
    return dim_outlet.select(*OUTLET_COLUMNS, *more)


def linked_listings(valid_portfolio: DataFrame) -> DataFrame:
    """What the fact reads of the valid listings, for a table that is dealt
    for the join: rows that can't meet an outlet are left out."""
    return valid_portfolio.select(*LISTING_COLUMNS).dropna(subset=["id_outlet", "id_beverage", "market", "id_ext_link"])


def fct_listing(valid_portfolio: DataFrame, dim_outlet: DataFrame, dim_product: DataFrame | None = None,
                weights: tuple[str, str] | None = None, spread: int = 0) -> DataFrame:
    """One row per valid listing (a portfolio file row) that maps to an outlet.

    The reference writes LEFT JOIN dim_outlet + ``outlet_key IS NOT NULL``;
    the outlet key is never NULL on a match, so this is an inner join (the
    form Catalyst itself derives).  Listings join on (market, id_ext_link) --
    not id_outlet -- and duplicate outlet rows fan out, as in the reference.
    Both joins shuffle on compound high-cardinality keys; AQE broadcasts a
    side at runtime only when its measured size is under the threshold and
    splits skewed partitions otherwise.

    ``dim_product=None`` states that the product dimension is built from
    these same listings (as in a layered build): every listing with an
    id_beverage then has its product row, so the LEFT JOIN only ever yields
    ``surrogate_key(market, id_beverage)`` -- computed directly, which saves
    a shuffle of every fact row.  Pass the dimension to join an external one.

    ``weights`` names a signed multiplicity of either side; their product is
    the fact row's, under the first name (see plans.deltas).

    ``spread`` (a number of tasks) deals hot links in pieces, see join_spread.
    """
    left, right = ([w] for w in weights) if weights else ([], [])
    listings = (valid_portfolio
                .filter(F.col("id_outlet").isNotNull() & F.col("id_beverage").isNotNull())
                .select(*LISTING_COLUMNS, *left))
    outlets = dim_outlet.select(
        "market", "id_ext_link", "platform_key", "outlet_key", "serves_red_bull", "serves_drinks",
        "is_chain", F.col("average_rating").alias("outlet_average_rating"),
        F.col("num_ratings").alias("outlet_num_ratings"), "delivery_fee", "min_order_amount", *[F.col(w).alias("_weight") for w in right])
    enriched = join_spread(listings, outlets, spread) if spread else listings.join(outlets, ["market", "id_ext_link"], "inner")
    if dim_product is None:
        enriched = enriched.withColumn("product_key", surrogate_key("market", "id_beverage"))
    else:
        products = dim_product.select("market", "id_beverage", "product_key")
        enriched = enriched.join(products, ["market", "id_beverage"], "left")
    return (enriched
            .withColumn("listing_key", surrogate_key("market", "source_file", "file_row_number"))
            .withColumn("market_key", surrogate_key("market"))
            .select(*FACT_COLUMNS, *[(F.col(w) * F.col("_weight")).alias(w) for w in left]))
