"""Bronze-shaped stand-ins derived from the driver's TPC-H-like tables.

The driver tables hold no NULLs and no orphan keys, so the defects the
pipeline must handle (NULL keys, bad numbers, missing timestamps, orphan
links, repeated row keys) are made by expression.  Each stand-in is one SQL
text that runs unchanged in Spark (``spark.sql`` with DataFrame arguments,
no global views) and in DuckDB (the oracle), so both engines see identical
bronze rows.  Every stand-in scales with the table it is derived from.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SOURCE_FIELDS

# Fixed value: the one load time of the stand-in bronze batch (S5: a load
# timestamp is a constant per load, injected as a literal).
STANDIN_LOAD_TS = "2024-06-01 00:00:00"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# --- payload expressions per source (fields not listed are NULL text) --------

_OUTLET = {
    "id_ext_link": "case when c_custkey % 499 = 0 then null else c_name end",
    "id_outlet": "cast(c_custkey % 150 as string)",
    "id_platform": "case when c_custkey % 97 = 0 then null else cast(c_nationkey % 4 as string) end",
    "platform_name": "concat('Plat-', c_mktsegment, ' ', cast(c_nationkey % 4 as string))",
    "link": "concat('https://outlets.example/', cast(c_custkey as string))",
    "name": "c_name",
    "business": "concat(n_name, ' ', c_mktsegment)",
    "delivery": "case when c_custkey % 7 = 0 then 'free' else cast(c_nationkey % 5 as string) end",
    "category": "c_mktsegment",
    "latitude": "cast(c_nationkey as string)",
    "longitude": "case when c_custkey % 17 = 0 then '1.0d' else cast(c_nationkey - 12 as string) end",
    "num_ratings": "concat(cast(c_custkey % 300 as string), case when c_custkey % 4 = 0 then '.5' else '' end)",
    "average_rating": "case when c_custkey % 11 = 0 then 'n/a' else cast(c_acctbal as string) end",
    "city": "n_name",
    "min_order_amount": "case when c_custkey % 13 = 0 then 'NaN' else ' 10 ' end",
    "banner_available": "case when c_custkey % 3 = 0 then 'TRUE' when c_custkey % 3 = 1 then 'false' end",
    "street_address": "concat(cast(c_custkey as string), ' Main Street')",
    "postal_code": "cast(10000 + c_custkey as string)",
    "address_locality": "n_name",
    "address_country": "r_name",
    "website": "concat('https://', lower(c_mktsegment), '.example')",
    "ghost_kitchen": "case when c_custkey % 5 = 0 then '1' else '0' end",
    "local_currency": "case when c_nationkey % 2 = 0 then 'EUR' else 'USD' end",
    "created_at": "case when c_acctbal < 0 then 'n/a' else '2024-01-01 00:00:00' end",
    "segment_type": ("case when c_mktsegment = 'FURNITURE' then null "
                     "when c_mktsegment = 'MACHINERY' then 'pharmacy' "
                     "when c_mktsegment = 'HOUSEHOLD' then 'restaurant' "
                     "else 'grocery/convenience store/supermarket/liquor store' end"),
}

_MATCHING = {
    "id_outlet": "case when event_id % 211 = 0 then null else cast(user_id as string) end",
    "id_platform": "cast(user_id % 4 as string)",
    "platform_name": "concat('Uber-Eats ', event_type)",
    "id_ext_link": "concat('Customer#', cast(user_id as string))",
    "place_id": "concat('place-', cast(event_id as string))",
    "similarity_score_name": "case when event_type = 'view' then 'n/a' else cast(value as string) end",
    "similarity_score_address": "case when event_type = 'click' then cast(value as string) when event_type = 'signup' then 'Infinity' end",
    "merged_chain_name": "concat('chain-', cast(user_id % 10 as string))",
    "is_chain": "case when event_type = 'signup' and event_id % 30 = 0 then '1' end",
    "num_restaurants": "concat(cast(event_id % 50 as string), case when event_id % 2 = 0 then '.5' else '' end)",
    "serves_drinks": "case when event_id % 3 = 0 then '1' else '0' end",
    "serves_red_bull": "case when event_type = 'purchase' and event_id % 40 = 0 then '1' else '0' end",
    "sugar_free_available": "case when user_id % 7 = 0 then '1' end",
    "organics_available": "case when event_id % 9 = 0 then '1' else 'yes' end",
    "editions_available": "case when event_type = 'click' then '1' else '0' end",
    "ed": "cast(user_id % 9 as string)",
    "ed_comp": "case when event_id % 5 = 0 then '-2.5' else 'n/a' end",
    "sd_coke": "concat(cast(event_id % 4 as string), '.5')",
    "sd": "cast(event_id % 12 as string)",
    "leading_id_ext_link": "concat('Customer#', cast(user_id % 25 as string))",
    "created_at": "case when event_type = 'error' then '' else cast(ts as string) end",
}

_PORTFOLIO = {
    "id_beverage": "case when l_quantity = 50 then null else cast(l_partkey as string) end",
    "id_ext_link": ("case when l_linenumber = 7 then concat(c_name, '#x') "
                    "when l_linenumber = 6 then null else c_name end"),
    "id_outlet": "case when l_linenumber = 5 and l_tax = 0 then null else cast(c_custkey % 150 as string) end",
    "item_position": "concat('P', cast(l_linenumber as string))",
    "item_category": ("case when p_size <= 10 then 'Drinks' when p_size <= 20 then 'Burgers' "
                      "when p_size <= 25 then 'Fingerfood' else p_type end"),
    "id_drink": "cast(l_partkey % 100 as string)",
    "item_manufacturer": "p_brand",
    "item_brand": "p_brand",
    "item_subbrand": "concat(p_brand, ' ', p_type)",
    "item_volume": "case when p_size % 9 = 0 then 'large' else cast(p_size * 10 as string) end",
    "item_price": "case when l_discount = 0 then '' else cast(l_extendedprice as string) end",
    "id_category": "p_type",
    "item_drink_category_1": "case when p_size <= 25 then 'Soft Drinks' end",
    "item_drink_category_2": "case when p_size <= 10 then 'Cola' end",
    "item_image_url": "concat('https://img.example/', cast(l_partkey as string), '.png')",
    "item_name": ("case when p_size <= 5 then concat(p_name, ' 250ml can') "
                  "when p_size <= 20 then concat(p_name, ' menu') else p_name end"),
    "item_desc": ("case when p_size between 21 and 25 then concat(p_name, ' snack with selectable drink') "
                  "when p_size between 26 and 28 then 'large sharing box with optional drink' end"),
    "addon_prompt": "case when l_linenumber % 2 = 0 then '1' else '0' end",
    "addon_prompt_text": ("case when l_linenumber in (2, 4) then 'choose your drink' "
                          "when l_linenumber = 3 then 'optional drink selection' end"),
    "packaging_size": "cast(p_size as string)",
    "banner_available": "case when l_returnflag = 'A' then 'TRUE' when l_returnflag = 'N' then 'true' else 'no' end",
    "created_at": "case when l_returnflag = 'R' then null else cast(l_shipdate as string) end",
}

_FROM = {
    "outlet": ("from {customer} join {nation} on c_nationkey = n_nationkey "
               "join {region} on n_regionkey = r_regionkey"),
    "matching": "from {events} join {region} on r_regionkey = user_id % 5",
    "portfolio": ("from {lineitem} join {orders} on l_orderkey = o_orderkey "
                  "join {customer} on o_custkey = c_custkey "
                  "join {nation} on c_nationkey = n_nationkey "
                  "join {region} on n_regionkey = r_regionkey "
                  "join {part} on l_partkey = p_partkey"),
}

# The same rows for Spark: an order's market and customer are found before the
# lines come in, so the lines are moved once by order and once by part.
_FROM_SPARK = _FROM | {
    "portfolio": ("from {lineitem} join (select o_orderkey, c_custkey, c_name, r_name from {orders} "
                  "join {customer} on o_custkey = c_custkey "
                  "join {nation} on c_nationkey = n_nationkey "
                  "join {region} on n_regionkey = r_regionkey) o on l_orderkey = o_orderkey "
                  "join {part} on l_partkey = p_partkey"),
}

_META = {
    "outlet": ("concat(' ', lower(r_name), ' ')", "concat('OUTLET/', r_name, '/', c_mktsegment, '.tsv')",
               "c_custkey"),
    "matching": ("concat(' ', lower(r_name), ' ')", "concat('MATCHING/', r_name, '/', event_type, '.tsv')",
                 "event_id"),
    "portfolio": ("concat(' ', lower(r_name), ' ')", "concat('PORTFOLIO/', r_name, '/', l_returnflag, '.tsv')",
                  "l_orderkey * 10 + l_linenumber"),
}

_PAYLOAD = {"outlet": _OUTLET, "matching": _MATCHING, "portfolio": _PORTFOLIO}

SOURCES = ("outlet", "portfolio", "matching")

#: The driver table that a stand-in has a row of each.
ROWS_OF = {"outlet": "customer", "portfolio": "lineitem", "matching": "events"}


def _load_ts(engine: str) -> str:
    kind = "timestamp_ntz" if engine == "spark" else "timestamp"
    return f"cast('{STANDIN_LOAD_TS}' as {kind})"


def parsed_sql(source: str, engine: str, with_raw: bool = False) -> str:
    """SELECT text of a bronze *parsed* stand-in (all payload columns text).

    ``with_raw`` adds ``raw_data``: the record as landed (tab-joined
    fields, NULL as empty), carried from the same scan.
    """
    market, source_file, row = _META[source]
    cols = [f"{market} as market", f"{source_file} as source_file",
            f"cast({row} as bigint) as file_row_number", f"{_load_ts(engine)} as load_timestamp"]
    payload = _PAYLOAD[source]
    for f in SOURCE_FIELDS[source]:
        cols.append(f"{payload.get(f, 'cast(null as string)')} as {f}")
    if with_raw:
        parts = ", ".join(f"coalesce({payload[f]}, '')" if f in payload else "''"
                          for f in SOURCE_FIELDS[source])
        cols.append(f"concat_ws(chr(9), {parts}) as raw_data")
    return "select " + ",\n  ".join(cols) + "\n" + (_FROM_SPARK if engine == "spark" else _FROM)[source]


def with_raw_text(parsed: DataFrame, source: str) -> DataFrame:
    """Parsed stand-in rows with ``raw_data`` put together from their fields:
    the same text as ``parsed_sql`` with ``with_raw``, so that a stand-in
    written as a table needn't hold it."""
    return parsed.withColumn("raw_data", F.concat_ws("\t", *[F.coalesce(F.col(f), F.lit("")) for f in SOURCE_FIELDS[source]]))


def duckdb_sql(text: str) -> str:
    """Bind ``{table}`` placeholders to the oracle's pre-registered views."""
    return text.format(**{t: t for t in DRIVER_TABLES})


class DriverTables:
    """The driver tables of one scale factor, each read once
    per query build, and only when a plan uses it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache = spark, sf_dir.rstrip("/"), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._cache[name] = df
        return self._cache[name]


_ACTIVE = threading.local()


@contextmanager
def table_scope(spark: SparkSession, sf_dir: str):
    """Within the block, every stand-in of (spark, sf_dir) shares one
    DriverTables, so a query build reads each table's footer once."""
    prev = getattr(_ACTIVE, "tables", None)
    _ACTIVE.tables = DriverTables(spark, sf_dir)
    try:
        yield _ACTIVE.tables
    finally:
        _ACTIVE.tables = prev


def _tables(spark, sf_dir, tables=None) -> DriverTables:
    if tables is not None:
        return tables
    active = getattr(_ACTIVE, "tables", None)
    if active is not None and active.spark is spark and active.sf_dir == sf_dir.rstrip("/"):
        return active
    return DriverTables(spark, sf_dir)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _tables(spark, sf_dir)[name]


def parsed_standin(spark: SparkSession, sf_dir: str, source: str,
                   with_raw: bool = False, tables: DriverTables | None = None) -> DataFrame:
    tables = _tables(spark, sf_dir, tables)
    text = parsed_sql(source, "spark", with_raw)
    used = {t: tables[t] for t in DRIVER_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def standin_bronze(spark: SparkSession, sf_dir: str, with_raw: bool = True) -> dict[str, DataFrame]:
    """The three parsed bronze stand-ins keyed by source name."""
    return {s: parsed_standin(spark, sf_dir, s, with_raw) for s in SOURCES}
