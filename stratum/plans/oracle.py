"""ANSI SQL twins of the registered queries, run by DuckDB as the oracle.

They are written the way the reference writes its models (CTEs, CASE
ladders, LEFT JOIN + IS NULL, ROW_NUMBER), over the same stand-in bronze
text, so a match means the Spark operators reproduce the models' meaning.
"""

from __future__ import annotations

from ..functions import casts
from ..functions.keys import surrogate_key_sql as sk
from ..operators import conform, quality
from ..sources import standins

KEYS = "market, source_file, file_row_number"

_CONV = {
    "text": lambda c: c,
    "double": casts.safe_double_sql,
    "number": casts.safe_number_sql,
    "timestamp": casts.safe_timestamp_sql,
    "flag1": casts.flag_one_sql,
    "flag_true": casts.flag_true_sql,
    "alnum_lower": lambda c: f"lower(regexp_replace({c}, '[^a-zA-Z0-9]', '', 'g'))",
}


def bronze_cte(source: str) -> str:
    return f"{source}_parsed as ({standins.duckdb_sql(standins.parsed_sql(source, 'duckdb', True))})"


def stg_cte(source: str) -> str:
    spec = conform.SPECS[source]
    cols = ["upper(trim(market)) as market", "source_file", "file_row_number"]
    cols += [f"{_CONV[kind](src)} as {out}" for out, kind, src in spec]
    cols += ["raw_data as raw_record", "load_timestamp"]
    return f"stg_{source} as (select {', '.join(cols)} from {source}_parsed)"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_RULE_SQL = {
    "outlet": [("created_at is null", quality.MISSING_CREATED_AT),
               ("segment_type not in (" + ", ".join(_sql_str(s) for s in quality.ACCEPTED_SEGMENTS) + ")",
                quality.INVALID_SEGMENT_TYPE)],
    "portfolio": [("item_price is null", quality.MISSING_ITEM_PRICE)],
    "matching": [("created_at is null", quality.MISSING_CREATED_AT)],
}


def rejected_cte(source: str) -> str:
    rules = _RULE_SQL[source]
    code = "case " + " ".join(f"when {p} then {_sql_str(c)}" for p, (c, _) in rules) + " end"
    reason = "case " + " ".join(f"when {p} then {_sql_str(r)}" for p, (_, r) in rules) + " end"
    data = [out for out, _, _ in conform.SPECS[source]]
    return (f"cls_{source} as (select *, {code} as error_code, {reason} as error_reason from stg_{source}),\n"
            f"rej_{source} as (select {KEYS}, error_code, error_reason, raw_record, load_timestamp, "
            f"{', '.join(data)} from cls_{source} where error_code is not null)")


def valid_cte(source: str) -> str:
    return (f"val_{source} as (select s.* from stg_{source} s left join rej_{source} r "
            f"on s.market = r.market and s.source_file = r.source_file "
            f"and s.file_row_number = r.file_row_number where r.file_row_number is null)")


def layer_ctes(sources=("outlet", "portfolio", "matching"), valid=True) -> list[str]:
    out = []
    for s in sources:
        out += [bronze_cte(s), stg_cte(s), rejected_cte(s)]
        if valid:
            out.append(valid_cte(s))
    return out


def with_(ctes: list[str], body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


SCOPE_CTE = ("scope as (select upper(trim(r_name)) as market, "
             "concat(upper(substr(r_name, 1, 1)), lower(substr(r_name, 2))) as market_name from region)")

DIM_PLATFORM_CTE = (
    "dim_platform as (select " + sk("market", "id_platform") + " as platform_key, " + sk("market") +
    " as market_key, market, id_platform, platform_name from (select market, id_platform, platform_name, "
    "row_number() over (partition by market, id_platform order by load_timestamp desc nulls first, "
    "platform_name asc nulls last, source_file asc nulls last, file_row_number asc nulls last) as row_num "
    "from val_outlet where id_platform is not null) d where row_num = 1)")

_FLAGS = ["serves_drinks", "serves_red_bull", "sugar_free_available", "organics_available",
          "editions_available", "is_chain"]

_OUTLET_COPIED = ("id_outlet", "id_ext_link", "id_platform", "platform_name", "business_name", "primary_category", "segment_type",
                  "latitude", "longitude", "city", "street_address", "postal_code", "address_state_locality", "address_country",
                  "num_ratings", "average_rating", "delivery_fee", "min_order_amount", "local_currency", "is_banner_available",
                  "is_ghost_kitchen", "created_at", "link", "website")


def _signal(expr: str) -> str:
    """One figure over the outlet's valid matching rows."""
    return f"(select {expr} from val_matching s where s.market = v.market and s.id_outlet = v.id_outlet)"


# An outlet per valid outlet row; signals are looked up row by row.
DIM_OUTLET_CTE = (
    "dim_outlet as (select " + ", ".join(
        [sk("v.market", "v.id_ext_link") + " as outlet_key", sk("v.market") + " as market_key",
         sk("v.market", "v.id_platform") + " as platform_key", "v.market", "v.name as outlet_name"]
        + [f"v.{c}" for c in _OUTLET_COPIED]
        + [f"exists (select 1 from val_matching s where s.market = v.market and s.id_outlet = v.id_outlet and s.{f}) as {f}" for f in _FLAGS]
        + [_signal("max(s.num_restaurants)") + " as num_restaurants",
           _signal("avg(s.similarity_score_name)") + " as avg_similarity_score_name",
           _signal("avg(s.similarity_score_address)") + " as avg_similarity_score_address"])
    + " from val_outlet v where v.id_outlet is not null)")

_PRODUCT_COLS = ("market, id_beverage, id_drink, id_category, item_name, item_brand, item_subbrand, "
                 "item_manufacturer, menu_category, drink_category_primary, drink_category_secondary, "
                 "item_description, item_volume_ml, packaging_size, item_image_url, has_addon_prompt, "
                 "addon_text, created_at")

DIM_PRODUCT_CTE = (
    "dim_product as (select " + sk("market", "id_beverage") + " as product_key, " + sk("market")
    + " as market_key, " + _PRODUCT_COLS + " from (select *, row_number() over (partition by market, "
    "id_beverage order by created_at desc nulls last, load_timestamp desc nulls first, "
    "source_file asc nulls last, file_row_number asc nulls last, "
    + ", ".join(f"{c.strip()} asc nulls last" for c in _PRODUCT_COLS.split(",")[2:])
    + ") as row_num from val_portfolio "
    "where id_beverage is not null) d where row_num = 1)")

# Listing columns as they are, and the outlet's under the fact's names.
_FACT_OWN = ("source_file", "file_row_number", "id_outlet", "id_beverage", "item_name", "item_price", "item_volume_ml",
             "item_position_code", "menu_category", "is_banner_available", "has_addon_prompt", "created_at", "load_timestamp")
_FACT_OUTLET = {"platform_key": "platform_key", "outlet_key": "outlet_key", "serves_red_bull": "serves_red_bull",
                "serves_drinks": "serves_drinks", "is_chain": "is_chain", "average_rating": "outlet_average_rating",
                "num_ratings": "outlet_num_ratings", "delivery_fee": "delivery_fee", "min_order_amount": "min_order_amount"}

# Every kept listing meets each outlet row of its link; a product key exists
# for every beverage that any valid listing names, so it is the beverage's.
FACT_CTE = (
    "fct as (with own as (select market, id_ext_link, " + ", ".join(_FACT_OWN) + " from val_portfolio "
    "where id_beverage is not null and id_outlet is not null), places as (select market, id_ext_link, "
    + ", ".join(f"{c} as {n}" for c, n in _FACT_OUTLET.items()) + " from dim_outlet) "
    "select *, " + sk("market") + " as market_key, " + sk("market", "id_beverage") + " as product_key, "
    + sk("market", "source_file", "file_row_number") + " as listing_key from own join places using (market, id_ext_link))")


def gold_ctes() -> list[str]:
    return layer_ctes() + [SCOPE_CTE, DIM_PLATFORM_CTE, DIM_OUTLET_CTE, DIM_PRODUCT_CTE, FACT_CTE]


def round6(col: str) -> str:
    """Aggregated doubles are reported to 6 decimals (nudged off exact ties)."""
    return f"round({col} + 1e-9, 6) as {col}"


# --- audit, checks, access ----------------------------------------------------------

def bronze_ctes_raw(sources=("outlet", "portfolio", "matching")) -> list[str]:
    return [bronze_cte(s) for s in sources]


EXPECTED_CTE = (
    "expected as (select s.source_name, m.market from "
    "(select market from scope union all select * from (values ('USA'), ('GBR'), ('DEU')) r(market)) m, "
    "(values ('outlet'), ('portfolio'), ('matching')) s(source_name))")

# Expected pairs count 0 rows each, landed rows 1: what sums to 0 is missing.
ACTUAL_COVERAGE_CTE = "tally as (select source_name, market, true as wanted, 0 as n, null as f from expected" + "".join(
    f" union all select '{s}', upper(trim(market)), false, 1, source_file from {s}_parsed"
    for s in ("outlet", "portfolio", "matching")) + ")"

COVERAGE_AUDIT_BODY = (
    "select source_name, market, cast(sum(n) as bigint) as row_count, count(distinct f) as source_file_count, "
    "if(sum(n) = 0, 'missing_expected_market', 'present') as coverage_status "
    "from tally group by all having bool_or(wanted) order by all")

MISSING_COVERAGE_BODY = "select source_name, market from tally group by all having sum(n) = 0"

DIM_MARKET_CTE = "dim_market as (select " + sk("market") + " as market_key, market, market_name from scope)"

CHECK_CTE_NAMES = {
    "stg_outlets": "stg_outlet", "stg_portfolio": "stg_portfolio", "stg_matching": "stg_matching",
    "int_outlets_valid": "val_outlet", "int_portfolio_valid": "val_portfolio",
    "int_matching_valid": "val_matching", "int_outlets_rejected": "rej_outlet",
    "int_portfolio_rejected": "rej_portfolio", "int_matching_rejected": "rej_matching",
    "fct_outlet_product_listing": "fct", "missing_source_coverage": "missing",
}


def _check_failures_sql(c) -> str:
    t = CHECK_CTE_NAMES.get(c.model, c.model)
    cols = ", ".join(c.columns)
    if c.kind == "not_null":
        return f"(select count(*) from {t} where {c.columns[0]} is null)"
    if c.kind == "unique":
        col = c.columns[0]
        return (f"(select count(*) from (select {col} from {t} where {col} is not null "
                f"group by {col} having count(*) > 1) x)")
    if c.kind == "unique_combination":
        return f"(select count(*) from (select {cols} from {t} group by {cols} having count(*) > 1) x)"
    if c.kind == "accepted_values":
        vals = ", ".join(_sql_str(v) for v in c.values)
        return f"(select count(*) from (select distinct {cols} from {t}) x where {cols} not in ({vals}))"
    if c.kind == "relationships":
        p = CHECK_CTE_NAMES.get(c.parent, c.parent)
        return (f"(select count(*) from {t} ch where ch.{cols} is not null and not exists "
                f"(select 1 from {p} pa where pa.{c.parent_column} = ch.{cols}))")
    if c.kind == "custom":
        return f"(select count(*) from {t})"
    raise ValueError(c.kind)


def checks_sql(suite) -> str:
    rows = " union all ".join(
        f"select {_sql_str(c.check_name)} as check_name, {_sql_str(c.model)} as model, "
        f"{_sql_str(','.join(c.columns))} as column_name, {_sql_str(c.severity)} as severity, "
        f"cast({_check_failures_sql(c)} as bigint) as failures" for c in suite)
    body = (f"select check_name, model, column_name, severity, failures, "
            f"case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status "
            f"from ({rows}) r")
    missing = f"missing as ({MISSING_COVERAGE_BODY})"
    return with_(gold_ctes() + [DIM_MARKET_CTE, EXPECTED_CTE, ACTUAL_COVERAGE_CTE, missing], body)


ENT_CTE = ("ent as (select concat('MARKET_', replace(market, ' ', '_'), '_ANALYST') as role_name, market from scope "
           "union all select 'MARKET_HQ_ANALYST' as role_name, market from scope)")

ADMIN_ROLES_SQL = "('ACCOUNTADMIN', 'SYSADMIN', 'SECURITYADMIN')"


def _policy(role: str, table_alias: str) -> str:
    return (f"(exists (select 1 from ent where ent.role_name = '{role}' and ent.market = {table_alias}.market) "
            f"or '{role}' in {ADMIN_ROLES_SQL})")


def row_access_body(role: str, avg_cols) -> str:
    excl = ", ".join(avg_cols)
    rounded = ", ".join(round6(c) for c in avg_cols)
    return f"select * exclude ({excl}), {rounded} from dim_outlet d where {_policy(role, 'd')}"


def role_visibility_body(probe_roles) -> str:
    probes = " union all ".join(f"select '{r}' as role_name" for r in probe_roles)
    return (
        f"select r.role_name as active_role, coalesce(array_to_string(list_sort(list(distinct d.market)), ','), '') "
        f"as visible_markets from (select distinct role_name from (select role_name from ent union all {probes}) q) r "
        f"left join dim_outlet d on (exists (select 1 from ent where ent.role_name = r.role_name "
        f"and ent.market = d.market) or r.role_name in {ADMIN_ROLES_SQL}) group by r.role_name")


def role_counts_body(role: str) -> str:
    return (f"select market, count(*) as listing_count from fct f where {_policy(role, 'f')} "
            f"group by market order by market")


# --- labels, json path, lineage -------------------------------------------------------

def _class_text_sql() -> str:
    from ..operators.labels import TEXT_PARTS
    parts = ", ".join(f"{_sql_str(lbl)}, coalesce(cast({c} as varchar), '')" for lbl, c in TEXT_PARTS)
    return f"concat({parts})"


def scoped_cte() -> str:
    from ..operators.labels import LISTING_COLUMNS
    return (f"scoped as (select {', '.join(LISTING_COLUMNS)}, {_class_text_sql()} as classification_text "
            f"from val_portfolio where coalesce(item_name, addon_text) is not null)")


def labelled_cte(scored_at: str) -> str:
    from ..operators.labels import NO_RULE, RULES, UNCLEAR
    lab = "case " + " ".join(f"when {r.sql()} then {_sql_str(r.label)}" for r in RULES) + f" else '{UNCLEAR}' end"
    rid = "case " + " ".join(f"when {r.sql()} then {_sql_str(r.rule_id)}" for r in RULES) + f" else '{NO_RULE}' end"
    return (f"review as (select *, {lab} as predicted_label, {rid} as rule_id, "
            f"cast(null as varchar) as manual_review_label, cast(null as varchar) as manual_review_notes, "
            f"cast('{scored_at}' as timestamp) as scored_at from scoped)")


SAMPLE_ORDER = ("md5(concat_ws('|', market, source_file, cast(file_row_number as varchar))), "
                + ", ".join(f"{c} asc nulls last" for c in ("market", "source_file", "file_row_number",
                                                             "classification_text", "id_beverage",
                                                             "id_outlet", "id_drink")))
TWO_RUNS_CTE = ("runs as (select * replace (case when file_row_number % 2 = 0 then timestamp '{}' else timestamp '{}' end "
                "as scored_at) from review)")


def policy_counts_body(role: str) -> str:
    parts = " union all ".join(f"select '{t}' as relation, market from {c}" for t, c in (
        ("dim_market", "dim_market"), ("dim_platform", "dim_platform"), ("dim_outlet", "dim_outlet"), ("dim_product", "dim_product"),
        ("fct_outlet_product_listing", "fct")))
    return (f"select relation, market, count(*) as rows_seen from ({parts}) x where market in "
            f"(select market from ent where role_name = '{role}') group by all")


RECENT_ORDER = "scored_at desc nulls last, " + ", ".join(
    f"{c} asc nulls last" for c in ("market", "source_file", "file_row_number", "classification_text",
                                    "id_beverage", "id_outlet", "id_drink"))


# --- ingest -----------------------------------------------------------------------------

def landed_ctes() -> list[str]:
    from ..sources import landed_events
    rows = landed_events.ROWS_SQL.format(events="events", region="region")
    return [f"landed as ({rows})",
            "numbered as (select *, cast(row_number() over (partition by market, bucket order by seq) "
            "+ coalesce(sum(length(line) - length(replace(line, chr(10), ''))) over (partition by market, bucket "
            "order by seq rows between unbounded preceding and 1 preceding), 0) as bigint) as file_row_number "
            "from landed)"]


SOURCE_DIR_SQL = "concat('MATCHING/market=', market, '/bucket=', cast(bucket as varchar), '/')"


def _null_if(x: str) -> str:
    return f"case when {x} in ('NULL', 'null', '') then null else {x} end"


def ingest_parsed_body(load_ts: str) -> str:
    from ..sources.schemas import MATCHING_FIELDS
    fields = ", ".join(f"{_null_if(f)} as {f}" for f in MATCHING_FIELDS)
    return (f"select market, {SOURCE_DIR_SQL} as source_dir, file_row_number, "
            f"cast('{load_ts}' as timestamp) as load_timestamp, {fields} from numbered")


def ingest_raw_body(load_ts: str) -> str:
    return (f"select market, {SOURCE_DIR_SQL} as source_dir, file_row_number, "
            f"cast('{load_ts}' as timestamp) as load_timestamp, {_null_if('trim(line)')} as raw_data from numbered")


FILE_REJECT_BODY = f"select {SOURCE_DIR_SQL} as source_dir, 'UNBALANCED_QUOTES' as issue from landed where stray"
PARSE_ISSUES_BODY = f"select market, {SOURCE_DIR_SQL} as source_dir, file_row_number from numbered where stray"


def ingest_lines_body(load_ts: str) -> str:
    """Raw rows as the line format reads them: each physical line is one."""
    return (f"select market, source_dir, file_row_number + i as file_row_number, cast('{load_ts}' as timestamp) as load_timestamp, "
            f"{_null_if('trim(part)')} as raw_data from (select market, {SOURCE_DIR_SQL} as source_dir, file_row_number, "
            "unnest(range(0, len(string_split(line, chr(10))))) as i, unnest(string_split(line, chr(10))) as part from numbered) x")


# --- monitoring extensions -------------------------------------------------------------------

def _rate_sql(num: str, den: str) -> str:
    return f"round(cast({num} as double) / nullif(cast({den} as double), 0) + 1e-9, 6)"


def layer_counts_body() -> str:
    parts = []
    for s in ("outlet", "portfolio", "matching"):
        parts += [f"select '{s}' as source_name, upper(trim(market)) as market, 'bronze' as layer, count(*) as n "
                  f"from {s}_parsed group by 2",
                  f"select '{s}', market, 'valid', count(*) from val_{s} group by 2",
                  f"select '{s}', market, 'rejected', count(*) from rej_{s} group by 2"]
    parts.append("select 'portfolio', market, 'gold', count(*) from fct group by 2")
    cols = ", ".join(f"cast(coalesce(sum(case when layer = '{lay}' then n end), 0) as bigint) as {lay}_rows"
                     for lay in ("bronze", "valid", "rejected", "gold"))
    return f"select source_name, market, {cols} from ({' union all '.join(parts)}) x group by source_name, market"


REJECT_TREND_BODY = " union all ".join(
    f"select '{s}' as source_name, date_trunc('day', load_timestamp) as load_period, error_code, "
    f"count(*) as rejected_rows from rej_{s} group by 2, 3" for s in ("outlet", "portfolio", "matching"))

JOIN_COVERAGE_BODY = (
    "select l.market, count(*) as listings, count(k.hit) as matched_listings, "
    + _rate_sql("count(k.hit)", "count(*)") + " as coverage_rate "
    "from (select market, id_ext_link from val_portfolio where id_outlet is not null and id_beverage is not null) l "
    "left join (select distinct market, id_ext_link, 1 as hit from dim_outlet) k "
    "on l.market = k.market and l.id_ext_link = k.id_ext_link group by l.market")


def freshness_body(as_of: str, max_age_hours: float) -> str:
    parts = " union all ".join(
        f"select '{s}' as source_name, upper(trim(market)) as market, max(load_timestamp) as last_load, "
        f"count(distinct source_file) as source_files from {s}_parsed group by 2"
        for s in ("outlet", "portfolio", "matching"))
    age = f"round((epoch_us(cast('{as_of}' as timestamp)) - epoch_us(last_load)) / 3.6e9, 3)"
    return (f"select source_name, market, last_load, source_files, {age} as age_hours, "
            f"case when {age} <= {max_age_hours} then 'fresh' else 'stale' end as freshness_status from ({parts}) f")


def score_incremental_body(cutoff: str) -> str:
    text = _class_text_sql()
    prev = (f"select market, source_file, file_row_number, case when file_row_number % 7 = 0 "
            f"then concat({text}, ' (old)') else {text} end as classification_text "
            f"from val_portfolio where coalesce(item_name, addon_text) is not null "
            f"and created_at < cast('{cutoff}' as timestamp)")
    return (f"select s.* from scoped s where not exists (select 1 from ({prev}) p where p.market = s.market "
            f"and p.source_file = s.source_file and p.file_row_number = s.file_row_number "
            f"and sha256(p.classification_text) = sha256(s.classification_text))")


def review_metrics_body(manual_sql: str) -> str:
    m = f"({manual_sql})"
    reviewed = f"{m} is not null"
    return (
        "select market, count(*) as scored_rows, "
        f"cast(sum(case when {reviewed} then 1 else 0 end) as bigint) as reviewed_rows, "
        + _rate_sql(f"sum(case when {reviewed} and predicted_label = {m} then 1 else 0 end)",
                    f"sum(case when {reviewed} then 1 else 0 end)") + " as agreement_rate, "
        + _rate_sql(f"sum(case when {reviewed} and predicted_label = 'meal_or_combo_with_drink' and {m} = "
                    f"'meal_or_combo_with_drink' then 1 else 0 end)",
                    f"sum(case when {reviewed} and predicted_label = 'meal_or_combo_with_drink' then 1 else 0 end)")
        + " as precision_positive, "
        + _rate_sql(f"sum(case when {reviewed} and predicted_label = 'meal_or_combo_with_drink' and {m} = "
                    f"'meal_or_combo_with_drink' then 1 else 0 end)",
                    f"sum(case when {reviewed} and {m} = 'meal_or_combo_with_drink' then 1 else 0 end)")
        + " as recall_positive, "
        + _rate_sql("sum(case when predicted_label = 'unclear_needs_review' then 1 else 0 end)", "count(*)")
        + " as review_rate from review group by market")


_PRODUCT_TIE = ", ".join(f"{c.strip()} asc nulls last" for c in _PRODUCT_COLS.split(",")[2:])
DIM_HISTORY_BODY = (
    "select market, id_beverage, item_name, menu_category, has_addon_prompt, t as valid_from, "
    "min(t) over later as valid_to, min(t) over later is null as is_current from ("
    "select d.*, exists (select 1 from (select * from picked p where p.market = d.market and p.id_beverage = d.id_beverage "
    "and coalesce(p.t, timestamp '0001-01-01') < coalesce(d.t, timestamp '0001-01-01') order by p.t desc nulls last limit 1) e "
    "where e.v is not distinct from d.v) as same from picked d) x where not same "
    "window later as (partition by market, id_beverage order by t nulls first rows between 1 following and 1 following)")
HISTORY_CTE = (
    "picked as (select market, id_beverage, item_name, menu_category, has_addon_prompt, created_at as t, "
    "row(item_name, menu_category, has_addon_prompt) as v from val_portfolio where id_beverage is not null "
    "qualify row_number() over (partition by market, id_beverage, created_at order by load_timestamp desc nulls first, "
    "source_file asc nulls last, file_row_number asc nulls last, " + _PRODUCT_TIE + ") = 1)")


_DRINK = ("market, id_drink, item_brand, item_subbrand, item_manufacturer, drink_category_primary, "
          "drink_category_secondary")

DIM_DRINK_BODY = (
    "select " + sk("market", "id_drink") + " as drink_key, " + sk("market") + " as market_key, " + _DRINK
    + " from (select *, row_number() over (partition by market, id_drink order by created_at desc nulls last, "
    "load_timestamp desc nulls first, source_file asc nulls last, file_row_number asc nulls last, "
    + ", ".join(f"{c.strip()} asc nulls last" for c in _DRINK.split(",")[2:])
    + ") as row_num from val_portfolio where id_drink is not null) d where row_num = 1")

BRIDGE_BODY = (
    "select " + sk("market", "id_beverage") + " as product_key, " + sk("market", "id_drink") + " as drink_key, "
    "market, id_beverage, id_drink, count(*) as listings from val_portfolio "
    "where id_beverage is not null and id_drink is not null group by market, id_beverage, id_drink")


# --- persisted labels, views, replaced partitions ------------------------------------------

def label_persisted_body(first: str, second: str) -> str:
    cols = "market, source_file, file_row_number, classification_text, predicted_label, manual_review_label"
    return (f"select {cols}, timestamp '{first}' as scored_at from review union all "
            f"select {cols}, timestamp '{second}' as scored_at from review where file_row_number % 2 = 0")


MODEL_VIEWS_BODY = " union all ".join(
    f"select '{n}' as model, market, count(*) as row_count from {c} group by market" for n, c in (
        ("int_outlet_valid", "val_outlet"), ("int_portfolio_valid", "val_portfolio"), ("int_matching_valid", "val_matching"),
        ("dim_market", "dim_market"), ("dim_platform", "dim_platform"), ("dim_outlet", "dim_outlet"), ("dim_product", "dim_product"),
        ("fct_outlet_product_listing", "fct")))

PARTITION_REPLACE_BODY = (
    "select case market when 'ASIA' then '' when 'EUROPE' then null else market end as market, platform_key, "
    "case when market = 'ASIA' then platform_name else 'before' end as platform_name from dim_platform where market <> 'AFRICA'")

# --- three loads -----------------------------------------------------------------------------

# Rows of the first load that come again in the third with an empty field.
BAD_AGAIN = {"outlet": ("file_row_number % 53 = 0", "created_at"), "portfolio": ("file_row_number % 89 = 0", "item_price"),
             "matching": ("file_row_number % 71 = 0", "created_at")}


def reloaded(ctes: list[str], sources=("outlet", "portfolio", "matching")) -> list[str]:
    """The CTEs over bronze with the bad copies of the third load."""
    out = list(ctes)
    for s in sources:
        rows, column = BAD_AGAIN[s]
        once = standins.duckdb_sql(standins.parsed_sql(s, "duckdb", True))
        again = f"{s}_parsed as (with once as ({once}) select * from once union all select * replace ('' as {column}) from once where {rows} and file_row_number % 5 < 3)"
        out[out.index(bronze_cte(s))] = again
    return out

DEADLINES_SQL = """
with f as (select event_type as source_name, upper(r_name) as market, date_trunc('milliseconds', ts) as ts,
    date_trunc('day', ts) + to_hours(cast(floor(hour(ts) / 6) as int) * 6) as start from events join region on r_regionkey = user_id % 5),
seen as (select max(ts) - interval 1 day as upto from f),
due as (select * from (select distinct start from f), (select distinct source_name, market from f)),
k as (select due.source_name, due.market, due.start, due.start + interval 1 hour as due, due.start + interval 6 hours as over, min(ts) as first
  from due left join f on f.source_name = due.source_name and f.market = due.market and f.start = due.start group by all),
bad as (select * from k where first is null or first > due)
select source_name, market, strftime(start, '%Y-%m-%d %H') as period, status, due, if(status = 'late', first, null) as delivered_at
from (select *, 'missed' as status from bad, seen where due <= upto
  union all select *, if(first is null, 'absent', 'late') from bad, seen where over <= upto)"""


def policy_views_body(roles) -> str:
    parts = []
    for r in roles:
        parts += [f"select '{r}' as active_role, 'secured__{t}' as relation, market, count(*) as rows_seen from {t} x where {_policy(r, 'x')} group by market"
                  for t in ("dim_platform", "dim_outlet")]
        parts.append(f"select '{r}' as active_role, 'role_markets' as relation, market, count(*) as rows_seen from ent where role_name = '{r}' group by market")
    return " union all ".join(parts)


# --- lines loaded apart, realigned ------------------------------------------------------------

def lineage_realigned_sql(parsed: str, raw: str) -> str:
    """Row by row: lookups of single texts, running values over whole files."""
    f = "market, source_file"
    near = (f"coalesce(last_value(shift ignore nulls) over (partition by {f} order by n rows between unbounded preceding and 1 preceding), 0) as before, "
            f"coalesce(first_value(shift ignore nulls) over (partition by {f} order by n rows between 1 following and unbounded following), fin, 0) as after")
    free = "not exists (select 1 from {m} m where m.market = r.market and m.source_file = r.source_file and m.rn = r.n)"
    left = "not exists (select 1 from {m} m where m.market = p.market and m.source_file = p.source_file and m.n = p.n)"
    return f"""
with p as (select upper(trim(market)) as market, source_file, file_row_number as n, line as t, * exclude (market, source_file, line) from ({parsed})),
r as (select upper(trim(market)) as market, source_file, file_row_number as n, raw_data as t from ({raw})),
differ as (select distinct {f} from ((select {f}, n, t from p except select {f}, n, t from r) union all (select {f}, n, t from r except select {f}, n, t from p))),
ends as (select {f}, theirs - ours as fin from (select {f}, max(n) as theirs from r group by all) join (select {f}, max(n) as ours from p group by all) using ({f})),
ps as (select p.*, fin from p semi join differ using ({f}) left join ends using ({f})),
rs as (select r.* from r semi join differ using ({f})),
m1 as (select {f}, a.n, b.n as rn from (select {f}, t, min(n) as n from ps group by all having count(*) = 1) a
  join (select {f}, t, min(n) as n from rs group by all having count(*) = 1) b using ({f}, t)),
steady1 as (select {f}, n, shift from (select *, {near} from (select m1.*, rn - n as shift, fin from m1 left join ends using ({f}))) where before <> after or shift = before),
around1 as (select *, {near} from (select ps.*, shift from ps left join steady1 using ({f}, n))),
led as (select {f}, p.n, p.t, unnest(list_distinct([n + before, n + after])) as rn from around1 p where {left.format(m="m1")}),
led2 as (select {f}, rn, min(l.n) as n from led l join (select {f}, n as rn, t from rs r where {free.format(m="m1")}) using ({f}, rn, t) group by {f}, rn),
m2 as (select * from m1 union all by name select {f}, n, min(rn) as rn from led2 group by {f}, n),
m3 as (select * from m2 union all by name select {f}, a.n, b.n as rn
  from (select *, row_number() over (partition by {f}, t order by n) as k from ps p where {left.format(m="m2")}) a
  join (select *, row_number() over (partition by {f}, t order by n) as k from rs r where {free.format(m="m2")}) b using ({f}, t, k)),
steady2 as (select {f}, n, shift from (select *, {near} from (select m2.*, rn - n as shift, fin from m2 left join ends using ({f}))) where before <> after or shift = before),
around2 as (select *, {near} from (select ps.*, shift from ps left join steady2 using ({f}, n))),
m4 as (select {f}, p.n, r.n as rn from around2 p join rs r using ({f}) where before = after and r.n = p.n + before and {left.format(m="m3")} and {free.format(m="m3")}),
kinds as (select *, 'unique' as kind from m1 union all by name select *, 'extended' as kind from m2 anti join m1 using ({f}, n)
  union all by name select *, 'repeated' as kind from m3 anti join m2 using ({f}, n) union all by name select *, 'position' as kind from m4
  union all by name select {f}, n, n as rn, 'same' as kind from p anti join differ using ({f}))
select p.market, p.source_file, p.n as file_row_number, p.id_outlet, p.id_platform, p.place_id, p.created_at, k.rn as raw_row_number, r.t as raw_record,
  coalesce(kind, 'none') as match_kind
from p left join kinds k using ({f}, n) left join r on r.market = p.market and r.source_file = p.source_file and r.n = k.rn"""


# --- one link with a third of the listings ----------------------------------------------------

HOT_LINK = ("EUROPE", "Chain#1")
HOT_ROWS = {"outlet": "file_row_number <= 3", "portfolio": "file_row_number % 10 = 1"}  # a listing's first line


def hot_linked(ctes: list[str]) -> list[str]:
    """The CTEs over bronze in which three outlets share a link that many listings have."""
    out, (market, link) = list(ctes), HOT_LINK
    for s, rows in HOT_ROWS.items():
        out[out.index(bronze_cte(s))] = (
            f"{s}_parsed as (select * replace (case when {rows} then '{market}' else market end as market, "
            f"case when {rows} then '{link}' else id_ext_link end as id_ext_link) from ({standins.duckdb_sql(standins.parsed_sql(s, 'duckdb', True))}))")
    return out


# --- drifted headers ---------------------------------------------------------------------------

def ingest_drifted_body(load_ts: str) -> str:
    """Every row as landed, but for the fields whose column is gone or renamed beyond recognition."""
    return (f"select * replace (case when source_dir like '%=3/' then null else place_id end as place_id, "
            f"case when source_dir like '%=4/' then null else sd end as sd) from ({ingest_parsed_body(load_ts)})")


def header_drift_body(headers: dict[int, tuple[str, ...]]) -> str:
    """The drift of each variant of header, once for all its files."""
    from ..sources.schemas import MATCHING_FIELDS
    plain = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"
    rows = ", ".join(f"({v}, {i}, '{c}')" for v, fields in headers.items() for i, c in enumerate(fields))
    layout = ", ".join(f"({i}, '{f}')" for i, f in enumerate(MATCHING_FIELDS))
    return f"""
with found(variant, pos, name) as (values {rows}), layout(place, field) as (values {layout}),
pairs as (select *, levenshtein({plain.format('name')}, {plain.format('field')}) as far from found, layout),
same as (select * from pairs where far = 0),
rest as (select * from pairs p where not exists (select 1 from same s where s.variant = p.variant and (s.pos = p.pos or s.field = p.field))),
close as (select * from rest p where far * 4 <= length({plain.format('field')}) and not exists (
  select 1 from rest o where o.variant = p.variant and (o.pos = p.pos or o.field = p.field) and (o.pos, o.field) <> (p.pos, p.field) and o.far <= p.far)),
bound as (select * from same union all select * from close),
drift as (select variant, if(far > 0, 'renamed', 'moved') as kind, field, place, name, pos from bound where far > 0 or place <> pos
  union all select variant, 'missing', field, place, null, null from (select distinct variant from found), layout
    where (variant, field) not in (select (variant, field) from bound)
  union all select variant, 'added', null, null, name, pos from found where (variant, pos) not in (select (variant, pos) from bound))
select {SOURCE_DIR_SQL} as source_dir, kind, field, place as position, name as found_name, pos as found_position
from (select distinct market, bucket from (select upper(r_name) as market, {{bucket}} as bucket from events join region on r_regionkey = user_id % 5))
join drift on variant = bucket % 8"""
