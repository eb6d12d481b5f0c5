"""A parsed/raw bronze pair with lineage defects, derived from ``orders``.

Raw rows are keyed with a differently padded market (both sides are
canonicalised before the join), some keys have no raw row, and some raw
keys are landed twice (the left join fans out, as the reference's does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SOURCE_FIELDS
from .standins import read_table

PARSED_SQL = ("select concat(' ', lower(o_orderstatus), ' ') as market, "
              "concat('OUTLET/', o_orderstatus, '/', o_orderpriority, '.tsv') as source_file, "
              "o_orderkey as file_row_number, cast(o_custkey as string) as id_ext_link from {orders}")

_RAW_COLS = ("concat(o_orderstatus, '  ') as market, "
             "concat('OUTLET/', o_orderstatus, '/', o_orderpriority, '.tsv') as source_file, "
             "case when o_orderkey % 7 = 0 then o_orderkey + 100000000 else o_orderkey end as file_row_number, "
             "concat_ws(chr(9), cast(o_custkey as string), o_orderpriority, cast(o_totalprice as string), "
             "cast(copy_no as string)) as raw_data")
_COPIES = "case when o_orderkey % 13 = 0 then 2 else 1 end"

RAW_SQL = {
    "spark": f"select {_RAW_COLS} from (select *, explode(sequence(1, {_COPIES})) as copy_no from {{orders}})",
    "duckdb": f"select {_RAW_COLS} from (select *, unnest(generate_series(1, {_COPIES})) as copy_no from {{orders}})",
}


def lineage_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, sf_dir, "orders")
    return spark.sql(PARSED_SQL, orders=orders), spark.sql(RAW_SQL["spark"], orders=orders)


# --- loaded apart -------------------------------------------------------------------------------

# Rows of ``events`` as lines; a third has a text that others share.  The
# parsed load missed some lines.  The raw load missed others, holds some twice,
# some changed and some further down.  Views came unchanged.
_APART = {
    "id_outlet": "case when event_id % 3 = 0 then 'same' else cast(user_id as string) end",
    "id_platform": "cast(user_id % 2 as string)",
    "place_id": "case when event_id % 3 <> 0 then concat('place ', cast(event_id as string)) end",
    "created_at": "case when event_id % 3 <> 0 then cast(ts as string) end",
}
_EDITED = "event_type <> 'view' and event_id % "
_APART_FILE = ("{market} as market, concat('MATCHING/', r_name, '/', event_type, '.tsv') as source_file, "
               "cast(row_number() over (partition by r_name, event_type order by {order}) as bigint) as file_row_number")


def _apart_text(values: dict[str, str]) -> str:
    return "concat_ws(chr(9), " + ", ".join(f"coalesce({values[f]}, '')" if f in values else "''" for f in SOURCE_FIELDS["matching"]) + ")"


APART_PARSED_SQL = ("select " + _APART_FILE.format(market="lower(r_name)", order="event_id") + ", "
                    + ", ".join(f"{e} as {f}" for f, e in _APART.items()) + f", {_apart_text(_APART)} as line "
                    f"from {{events}} join {{region}} on r_regionkey = user_id % 5 where not ({_EDITED}37 = 0)")

_RAW_VALUES = _APART | {"id_outlet": f"case when {_EDITED}53 = 0 then 'changed' else {_APART['id_outlet']} end"}
APART_RAW_SQL = {engine: (
    "select " + _APART_FILE.format(market="concat(' ', r_name)", order=f"event_id + case when {_EDITED}101 = 0 then 1000 else 0 end, event_id, copy_no") + ", "
    + _apart_text(_RAW_VALUES) + f" as raw_data from (select *, {each}case when {_EDITED}29 = 0 then 2 else 1 end)) as copy_no "
    f"from {{events}} where not ({_EDITED}41 = 0)) e join {{region}} on r_regionkey = user_id % 5")
    for engine, each in (("spark", "explode(sequence(1, "), ("duckdb", "unnest(generate_series(1, "))}


def loaded_apart(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parsed and raw bronze rows of ``matching``, numbered by loads of their own."""
    tables = {t: read_table(spark, sf_dir, t) for t in ("events", "region")}
    parsed = spark.sql(APART_PARSED_SQL, **tables).drop("line")
    parsed = parsed.withColumns({f: F.lit(None).cast("string") for f in SOURCE_FIELDS["matching"] if f not in _APART})
    return parsed, spark.sql(APART_RAW_SQL["spark"], **tables)
