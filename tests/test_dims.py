import datetime as dt

from helpers import bronze

from stratum.operators import checks, conform, dims, facts, quality
from stratum.sources import constants


def _valid(spark, source, rows):
    staged = conform.STAGERS[source](bronze(spark, source, rows))
    return quality.split(staged, quality.RULES[source])[0]


OK = {"created_at": "2024-01-01 00:00:00", "segment_type": "restaurant"}


def test_platform_tie_on_load_time_takes_smallest_name(spark):
    v = _valid(spark, "outlet", [dict(OK, id_platform="1", platform_name="b"),
                                 dict(OK, id_platform="1", platform_name="a"),
                                 dict(OK, id_platform=None, platform_name="z")])
    rows = dims.dim_platform(v).collect()
    assert [(r.id_platform, r.platform_name) for r in rows] == [("1", "a")]


def test_latest_load_wins_for_platform(spark):
    v = _valid(spark, "outlet", [dict(OK, id_platform="1", platform_name="a", load_timestamp=dt.datetime(2024, 1, 1)),
                                 dict(OK, id_platform="1", platform_name="b", load_timestamp=dt.datetime(2024, 2, 1))])
    assert dims.dim_platform(v).collect()[0].platform_name == "b"


def test_product_dated_row_beats_null_created_at(spark):
    v = _valid(spark, "portfolio", [
        {"id_beverage": "9", "item_price": "1.0", "item_name": "undated", "created_at": None},
        {"id_beverage": "9", "item_price": "1.0", "item_name": "dated", "created_at": "2023-01-01"},
    ])
    assert [r.item_name for r in dims.dim_product(v).collect()] == ["dated"]


def test_outlet_signals_default_false_and_aggregate(spark):
    outlets = _valid(spark, "outlet", [dict(OK, id_outlet="1", id_ext_link="L1"),
                                       dict(OK, id_outlet="2", id_ext_link="L2")])
    matching = _valid(spark, "matching", [
        {"id_outlet": "1", "serves_red_bull": "1", "num_restaurants": "3", "similarity_score_name": "0.5",
         "created_at": "2024-01-01"},
        {"id_outlet": "1", "serves_red_bull": "0", "num_restaurants": "4.5", "similarity_score_name": "1.5",
         "created_at": "2024-01-01"},
    ])
    d = {r.id_outlet: r for r in dims.dim_outlet(outlets, matching).collect()}
    assert d["1"].serves_red_bull is True and d["1"].num_restaurants == 5 and d["1"].avg_similarity_score_name == 1.0
    assert d["2"].serves_red_bull is False and d["2"].is_chain is False and d["2"].num_restaurants is None


def test_fact_drops_null_and_unmatched_links_and_fans_out_duplicates(spark):
    outlets = _valid(spark, "outlet", [dict(OK, id_outlet="1", id_ext_link="L1"),
                                       dict(OK, id_outlet="1", id_ext_link="L1"),   # duplicate outlet key
                                       dict(OK, id_outlet="2", id_ext_link="L2")])
    matching = _valid(spark, "matching", [])
    portfolio = _valid(spark, "portfolio", [
        {"id_beverage": "9", "id_outlet": "1", "id_ext_link": "L1", "item_price": "2.0"},
        {"id_beverage": "9", "id_outlet": "1", "id_ext_link": None, "item_price": "2.0"},
        {"id_beverage": "9", "id_outlet": "1", "id_ext_link": "nope", "item_price": "2.0"},
        {"id_beverage": "8", "id_outlet": "2", "id_ext_link": "L2", "item_price": "2.0"},
    ])
    d_out = dims.dim_outlet(outlets, matching)
    d_prod = dims.dim_product(portfolio)
    fact = facts.fct_listing(portfolio, d_out, d_prod)
    rows = fact.collect()
    assert sorted(r.id_ext_link for r in rows) == ["L1", "L1", "L2"]
    assert all(r.product_key is not None for r in rows)
    assert fact.columns == facts.FACT_COLUMNS
    tables = {"dim_outlet": d_out, "fct": fact}
    res = {r.check_name: r for r in checks.run_checks(
        [checks.unique("dim_outlet", "outlet_key"), checks.unique("fct", "listing_key"),
         checks.not_null("fct", "outlet_key")], tables).collect()}
    assert res["unique__dim_outlet__outlet_key"].failures == 1
    assert res["unique__dim_outlet__outlet_key"].status == "fail"
    assert res["unique__fct__listing_key"].failures == 1  # fan-out repeats the listing key
    assert res["not_null__fct__outlet_key"].status == "pass"


def test_dim_market_from_reference_scope(spark):
    rows = dims.dim_market(constants.reference_scope(spark)).collect()
    assert {r.market: r.market_name for r in rows} == {"USA": "United States", "GBR": "United Kingdom",
                                                      "DEU": "Germany"}
    assert len({r.market_key for r in rows}) == 3
