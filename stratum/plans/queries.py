"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through the bronze stand-ins and
runs the library's operators over whole tables.  ``ORACLE`` holds the
matching DuckDB SQL (same column names) where one exists.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts
from ..operators import access, alignment, audit, checks, conform, dims, facts, labels, learned, monitoring, quality
from ..session import shared_dir
from ..sources import constants, drift, ingest, landed_events, landing, layers, lineage, schemas, standins
from ..streaming import deadlines, file_ingest
from . import build, deltas, oracle
from . import run as run_layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _reported(df: DataFrame) -> DataFrame:
    """Whole numbers are decimal(38,0) inside; the registered queries report
    them as bigint (the stand-ins' counts are small)."""
    wide = {f.name for f in df.schema.fields if f.dataType == T.DecimalType(38, 0)}
    return df.select(*[F.col(c).try_cast("bigint").alias(c) if c in wide else c for c in df.columns]) if wide else df


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with standins.table_scope(spark, sf_dir):
                return _reported(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round6(df: DataFrame, cols) -> DataFrame:
    """Aggregated doubles reported to 6 decimals, nudged off exact half ties
    (summation order differs between engines)."""
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c) + F.lit(1e-9), 6))
    return df


def _bronze(spark, sf_dir, sources=standins.SOURCES, materialized=(), with_raw=True):
    """Stand-in bronze per source.  Sources named in ``materialized`` are
    written once as a bronze table (parquet in the shared folder), as real
    bronze is, so the several consumers in one gold plan scan a table
    instead of re-deriving the stand-in from the driver tables each time."""
    todo = [s for s in sources if s in materialized]
    out = {s: standins.parsed_standin(spark, sf_dir, s, with_raw=with_raw and s not in todo) for s in sources}
    if todo:
        # Independent writes: submitted together so their stages share the cores.
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            done = pool.map(lambda s: (s, layers.materialize(out[s], f"bronze-{s}")), todo)
            # the raw text is made of the written fields where it is read
            out.update({s: standins.with_raw_text(df, s) if with_raw else df for s, df in done})
    return out


def _scope(spark, sf_dir):
    return constants.scope_from_regions(standins.read_table(spark, sf_dir, "region"))


def _layers(spark, sf_dir, materialized=standins.SOURCES) -> build.Layers:
    """Gold build: raw lineage text is not read by any gold model, so the
    stand-in bronze is written without it."""
    return build.build(_bronze(spark, sf_dir, materialized=materialized, with_raw=False), _scope(spark, sf_dir))


# --- gold --------------------------------------------------------------------

@register("fact_listing", oracle.with_(oracle.gold_ctes(), "select * from fct"))
def fact_listing(spark, sf_dir):
    return _layers(spark, sf_dir).gold["fct_outlet_product_listing"]


@register("fact_listing_joined", oracle.with_(oracle.gold_ctes(), "select * from fct"))
def fact_listing_joined(spark, sf_dir):
    """The fact with its product key looked up in the dimension."""
    lay = _layers(spark, sf_dir)
    return facts.fct_listing(lay.valid["portfolio"], lay.gold["dim_outlet"], lay.gold["dim_product"])


@register("fact_hot_link", oracle.with_(oracle.hot_linked(oracle.gold_ctes()), "select * from fct"))
def fact_hot_link(spark, sf_dir):
    """J4 where one link of several outlets holds a quarter of the listings."""
    bronze = _bronze(spark, sf_dir, materialized=standins.SOURCES, with_raw=False)
    for s, rows in oracle.HOT_ROWS.items():
        hot = dict(zip(("market", "id_ext_link"), oracle.HOT_LINK))
        bronze[s] = bronze[s].withColumns({c: F.when(F.expr(rows), F.lit(v)).otherwise(F.col(c)) for c, v in hot.items()})
    lay = build.build(bronze, _scope(spark, sf_dir))
    return facts.fct_listing(lay.valid["portfolio"], lay.gold["dim_outlet"], spread=int(spark.conf.get("spark.sql.shuffle.partitions")))


@register("dim_market", oracle.with_([oracle.SCOPE_CTE],
                                     "select " + oracle.sk("market") + " as market_key, market, market_name from scope"))
def dim_market(spark, sf_dir):
    return dims.dim_market(_scope(spark, sf_dir))


@register("dim_platform", oracle.with_(oracle.layer_ctes(("outlet",)) + [oracle.DIM_PLATFORM_CTE],
                                       "select * from dim_platform"))
def dim_platform(spark, sf_dir):
    staged = conform.stg_outlets(standins.parsed_standin(spark, sf_dir, "outlet", True))
    v, _ = quality.split(staged, quality.OUTLET_RULES)
    return dims.dim_platform(v)


_AVG_COLS = ["avg_similarity_score_name", "avg_similarity_score_address"]


@register("dim_outlet", oracle.with_(
    oracle.layer_ctes(("outlet", "matching")) + [oracle.DIM_OUTLET_CTE],
    "select * exclude (avg_similarity_score_name, avg_similarity_score_address), "
    + ", ".join(oracle.round6(c) for c in _AVG_COLS) + " from dim_outlet"))
def dim_outlet(spark, sf_dir):
    b = _bronze(spark, sf_dir, ("outlet", "matching"))
    st = build.silver(b)
    v, _ = build.intermediate(st)
    return round6(dims.dim_outlet(v["outlet"], v["matching"]), _AVG_COLS)


@register("dim_product", oracle.with_(oracle.layer_ctes(("portfolio",)) + [oracle.DIM_PRODUCT_CTE],
                                      "select * from dim_product"))
def dim_product(spark, sf_dir):
    return dims.dim_product(_valid_portfolio(spark, sf_dir))


# --- silver / intermediate per source ------------------------------------------

def _per_source(source: str):
    @register(f"conform_{source}", oracle.with_([oracle.bronze_cte(source), oracle.stg_cte(source)],
                                                f"select * from stg_{source}"))
    def _conform(spark, sf_dir):
        return conform.STAGERS[source](standins.parsed_standin(spark, sf_dir, source, True))

    @register(f"reject_{source}", oracle.with_(oracle.layer_ctes((source,), valid=False),
                                               f"select * from rej_{source}"))
    def _reject(spark, sf_dir):
        staged = conform.STAGERS[source](standins.parsed_standin(spark, sf_dir, source, True))
        return quality.rejected(staged, quality.RULES[source])

    @register(f"valid_{source}", oracle.with_(oracle.layer_ctes((source,)), f"select * from val_{source}"))
    def _valid(spark, sf_dir):
        staged = build.silver(_bronze(spark, sf_dir, (source,), materialized=(source,)))[source]
        return quality.settled(staged, quality.RULES[source], source)


for _s in ("outlet", "portfolio", "matching"):
    _per_source(_s)


# --- checks, audit, access ---------------------------------------------------------

def _expected_scope(spark, sf_dir):
    """Markets expected per source: the data's regions plus the reference's
    three markets (absent from the stand-ins, so coverage gaps are real)."""
    return _scope(spark, sf_dir).select("market").unionByName(
        constants.reference_scope(spark).select("market"))


@register("coverage_audit", oracle.with_(oracle.bronze_ctes_raw() + [oracle.SCOPE_CTE, oracle.EXPECTED_CTE,
                                                                     oracle.ACTUAL_COVERAGE_CTE],
                                         oracle.COVERAGE_AUDIT_BODY))
def coverage_audit(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return audit.coverage_audit(bronze, constants.expected_coverage(_expected_scope(spark, sf_dir)))


@register("missing_coverage", oracle.with_(oracle.bronze_ctes_raw() + [oracle.SCOPE_CTE, oracle.EXPECTED_CTE,
                                                                       oracle.ACTUAL_COVERAGE_CTE],
                                           oracle.MISSING_COVERAGE_BODY))
def missing_coverage(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return audit.missing_coverage(bronze, constants.expected_coverage(_expected_scope(spark, sf_dir)))


CHECK_MODELS = {
    "stg_outlets": ("staged", "outlet"), "stg_portfolio": ("staged", "portfolio"),
    "stg_matching": ("staged", "matching"),
    "int_outlets_valid": ("valid", "outlet"), "int_portfolio_valid": ("valid", "portfolio"),
    "int_matching_valid": ("valid", "matching"),
    "int_outlets_rejected": ("rejected", "outlet"), "int_portfolio_rejected": ("rejected", "portfolio"),
    "int_matching_rejected": ("rejected", "matching"),
}


def model_tables(lay: build.Layers) -> dict[str, DataFrame]:
    tables = {name: getattr(lay, part)[src] for name, (part, src) in CHECK_MODELS.items()}
    tables.update(lay.gold)
    return tables


ACCEPTED_MARKETS = tuple(m for m, _ in constants.REFERENCE_MARKETS)


@register("checks_summary", oracle.checks_sql(checks.declared_suite(ACCEPTED_MARKETS)))
def checks_summary(spark, sf_dir):
    """The declared suite over every layer.  Layer tables are written once
    to the shared folder, so ~80 checks read tables instead of re-deriving
    the whole model per check."""
    base = shared_dir(spark, "warehouse", unique=True)
    bronze = _bronze(spark, sf_dir, materialized=standins.SOURCES, with_raw=False)
    lay = build.build(bronze, _scope(spark, sf_dir), persist=layers.layer_persister(base),
                      persist_staged=False, persist_rejected=False)
    tables = model_tables(lay)
    tables["missing_source_coverage"] = audit.missing_coverage(
        bronze, constants.expected_coverage(_expected_scope(spark, sf_dir)))
    return checks.run_checks(checks.declared_suite(ACCEPTED_MARKETS), tables)


@register("coverage_from_states", oracle.with_(oracle.bronze_ctes_raw() + [oracle.SCOPE_CTE, oracle.EXPECTED_CTE, oracle.ACTUAL_COVERAGE_CTE], oracle.COVERAGE_AUDIT_BODY))
def coverage_from_states(spark, sf_dir):
    """The audit of three loads from the state that each left; files
    are in several loads."""
    path, bronze = shared_dir(spark, "coverage", unique=True), _bronze(spark, sf_dir, with_raw=False)
    for load in range(3):
        part = {s: df.filter(F.pmod("file_row_number", F.lit(3)) == load) for s, df in bronze.items()}
        audit.coverage_state(part).write.mode("overwrite").parquet(f"{path}/load={load}")
    states = spark.read.parquet(path)
    return audit.audit_of(audit.coverage_of_states(states), constants.expected_coverage(_expected_scope(spark, sf_dir)))


ACCESS_ROLE = constants.role("EUROPE")


@register("row_access", oracle.with_(oracle.gold_ctes() + [oracle.ENT_CTE],
                                     oracle.row_access_body(ACCESS_ROLE, _AVG_COLS)))
def row_access(spark, sf_dir):
    b = _bronze(spark, sf_dir, ("outlet", "matching"))
    v, _ = build.intermediate(build.silver(b))
    d = round6(dims.dim_outlet(v["outlet"], v["matching"]), _AVG_COLS)
    return access.restrict(d, constants.entitlements(_scope(spark, sf_dir)), ACCESS_ROLE)


@register("policy_counts", oracle.with_(oracle.gold_ctes() + [oracle.DIM_MARKET_CTE, oracle.ENT_CTE], oracle.policy_counts_body(ACCESS_ROLE)))
def policy_counts(spark, sf_dir):
    """The policy on all five gold relations, rows seen per market."""
    lay = _layers(spark, sf_dir)
    seen = access.restrict_all(lay.gold, constants.entitlements(_scope(spark, sf_dir)), ACCESS_ROLE)
    return checks.union_all([df.groupBy("market").agg(F.count(F.lit(1)).alias("rows_seen")).select(F.lit(n).alias("relation"), "market", "rows_seen")
                             for n, df in seen.items()])


VIEW_ROLES = (ACCESS_ROLE, constants.HQ_ROLE, "SYSADMIN", constants.role("UNKNOWN"))


@register("policy_views", oracle.with_(oracle.layer_ctes(("outlet", "matching")) + [oracle.SCOPE_CTE, oracle.DIM_PLATFORM_CTE, oracle.DIM_OUTLET_CTE, oracle.ENT_CTE],
                                       oracle.policy_views_body(VIEW_ROLES)))
def policy_views(spark, sf_dir):
    """F17, R2, R3 in SQL: the same views read after ``SET VAR active_role``,
    and the entitlement as a table function."""
    v, _ = build.intermediate(build.silver(_bronze(spark, sf_dir, ("outlet", "matching"), with_raw=False)))
    views = access.policy_views({"dim_platform": dims.dim_platform(v["outlet"]), "dim_outlet": dims.dim_outlet(v["outlet"], v["matching"])},
                                constants.entitlements(_scope(spark, sf_dir)))
    out = []
    for r in VIEW_ROLES:
        spark.sql(f"SET VAR {access.ROLE_VARIABLE} = '{r}'")
        out += [spark.sql(f"select {access.ROLE_VARIABLE} as active_role, '{n}' as relation, market, count(*) as rows_seen from {n} group by market") for n in views]
        out.append(spark.sql(f"select '{r}' as active_role, 'role_markets' as relation, market, count(*) as rows_seen from role_markets('{r}') group by market"))
    return checks.union_all(out)


PROBE_ROLES = ("ACCOUNTADMIN", constants.role("UNKNOWN"))


@register("role_visibility", oracle.with_(oracle.layer_ctes(("outlet", "matching"))
                                          + [oracle.SCOPE_CTE, oracle.DIM_OUTLET_CTE, oracle.ENT_CTE],
                                          oracle.role_visibility_body(PROBE_ROLES)))
def role_visibility(spark, sf_dir):
    b = _bronze(spark, sf_dir, ("outlet", "matching"))
    v, _ = build.intermediate(build.silver(b))
    d = dims.dim_outlet(v["outlet"], v["matching"])
    ents = constants.entitlements(_scope(spark, sf_dir))
    roles = ents.select("role_name").unionByName(
        spark.createDataFrame([(r,) for r in PROBE_ROLES], "role_name string"))
    vis = access.visible_markets(d, ents, roles)
    return vis.select(F.col("role_name").alias("active_role"),
                      F.array_join("visible_markets", ",").alias("visible_markets"))


@register("role_counts", oracle.with_(oracle.gold_ctes() + [oracle.ENT_CTE],
                                      oracle.role_counts_body(constants.HQ_ROLE)))
def role_counts(spark, sf_dir):
    lay = _layers(spark, sf_dir, materialized=())  # a count needs a few columns: no bronze copies
    ents = constants.entitlements(_scope(spark, sf_dir))
    return access.role_listing_counts(lay.gold["fct_outlet_product_listing"], ents, constants.HQ_ROLE)


# --- labels -------------------------------------------------------------------------

# Fixed scoring time of the registered runs (outputs carry no wall clock).
SCORED_AT = "2024-06-02 00:00:00"


def _valid_portfolio(spark, sf_dir):
    """The valid listings; no consumer reads their raw text."""
    staged = build.silver(_bronze(spark, sf_dir, ("portfolio",), materialized=("portfolio",), with_raw=False))["portfolio"]
    return quality.settled(staged, quality.PORTFOLIO_RULES, "portfolio")


def _review(spark, sf_dir):
    scoped = labels.scope_sample(_valid_portfolio(spark, sf_dir), n=None)
    return labels.to_review_table(labels.label(scoped), SCORED_AT)


_LBL_CTES = oracle.layer_ctes(("portfolio",)) + [oracle.scoped_cte()]


@register("class_text", oracle.with_(_LBL_CTES, "select market, source_file, file_row_number, "
                                                "classification_text from scoped"))
def class_text(spark, sf_dir):
    return labels.scope_sample(_valid_portfolio(spark, sf_dir), n=None).select(
        "market", "source_file", "file_row_number", "classification_text")


@register("classify_rules", oracle.with_(_LBL_CTES + [oracle.labelled_cte(SCORED_AT)],
                                         "select market, source_file, file_row_number, predicted_label, "
                                         "rule_id from review"))
def classify_rules(spark, sf_dir):
    return _review(spark, sf_dir).select("market", "source_file", "file_row_number",
                                         "predicted_label", "rule_id")


@register("sample_scope", oracle.with_(_LBL_CTES, f"select * from scoped order by {oracle.SAMPLE_ORDER} "
                                                  "limit 500"))
def sample_scope(spark, sf_dir):
    return labels.scope_sample(_valid_portfolio(spark, sf_dir), n=500)


@register("label_counts", oracle.with_(_LBL_CTES + [oracle.labelled_cte(SCORED_AT)],
                                       "select predicted_label, count(*) as row_count from review "
                                       "group by predicted_label order by row_count desc, predicted_label"))
def label_counts(spark, sf_dir):
    return labels.label_counts(_review(spark, sf_dir))


RESCORED_AT = "2024-06-09 00:00:00"


@register("label_recent", oracle.with_(_LBL_CTES + [oracle.labelled_cte(SCORED_AT), oracle.TWO_RUNS_CTE.format(RESCORED_AT, SCORED_AT)],
                                       "select market, item_name, addon_text, menu_category, "
                                       "drink_category_primary, drink_category_secondary, item_price, "
                                       f"predicted_label from runs order by {oracle.RECENT_ORDER} limit 50"))
def label_recent(spark, sf_dir):
    """Two scoring runs: the even rows were scored again a week later."""
    at = F.when(F.col("file_row_number") % 2 == 0, F.lit(RESCORED_AT)).otherwise(F.lit(SCORED_AT)).cast("timestamp_ntz")
    scoped = labels.scope_sample(_valid_portfolio(spark, sf_dir))
    return labels.recent(labels.to_review_table(labels.label(scoped), at), 50)


# Reviewer labels of rows that no rule decides, in the registered run.
UNDECIDED_SQL = ("case when rule_id = 'no_rule' then case when element_at(split(item_name, ' '), -1) in ('ring', 'widget') then 'standalone_drink' "
                 "when right(item_brand, 1) in ('1', '2', '3') then 'unclear_needs_review' else 'meal_or_combo_with_drink' end end")


def _learned(spark, sf_dir, wanted=lambda review: review):
    """The reviews' ``wanted`` rows with learned labels.  They are picked before
    they are scored: Catalyst leaves a filter above a model's functions."""
    review = _review(spark, sf_dir).withColumn("manual_review_label", F.expr(UNDECIDED_SQL))
    review = layers.materialize(review.select(*quality.KEYS, "classification_text", "predicted_label", "rule_id", "manual_review_label"), "review")
    model = learned.fit(review.filter(~learned.is_held_out()))
    return learned.label(wanted(review), model).withColumn("held_out", learned.is_held_out())


@register("label_learned")
def label_learned(spark, sf_dir):
    """The rows no rule decides, labelled by a model of the reviews
    outside the held-out fold."""
    return _learned(spark, sf_dir).select("market", "source_file", "file_row_number", "predicted_label", "rule_id", "held_out")


@register("label_learned_metrics")
def label_learned_metrics(spark, sf_dir):
    """Precision and recall of the learned labels on held-out reviews."""
    return learned.metrics(_learned(spark, sf_dir, lambda review: learned.reviewed(review.filter(learned.is_held_out()))))


# --- bucketed layer tables ----------------------------------------------------------------------

#: Buckets of a layer table, at least; a larger table has more (``layers.buckets``).
BUCKETS = 16


@register("fact_bucketed", oracle.with_(oracle.gold_ctes(), "select * from fct"))
def fact_bucketed(spark, sf_dir):
    """J2 and J4 on tables dealt to buckets by their join keys: the valid
    split and the fact join exchange neither side."""
    silver = {s: conform.STAGERS[s](df) for s, df in _bronze(spark, sf_dir, with_raw=False).items()}
    read = {"portfolio": facts.LISTING_COLUMNS, "matching": [*quality.KEYS, *dims.SIGNAL_COLUMNS[1:], "created_at", "load_timestamp"]}
    silver |= {s: silver[s].select(*c, "raw_record") for s, c in read.items()}  # what the split and the fact read
    buckets = {s: layers.buckets(standins.read_table(spark, sf_dir, t).count(), BUCKETS) for s, t in standins.ROWS_OF.items()}
    staged = {s: layers.write_bucketed(df, f"stg_{s}", quality.KEYS, buckets[s]) for s, df in silver.items()}
    valid = {s: quality.split(df, quality.RULES[s])[0] for s, df in staged.items()}
    link = ["market", "id_ext_link"]
    outlets = layers.write_bucketed(dims.dim_outlet(valid["outlet"], valid["matching"]), "dim_outlet", link, buckets["portfolio"])
    listings = layers.write_bucketed(facts.linked_listings(valid["portfolio"]), "linked_listings", link, buckets["portfolio"])
    return facts.fct_listing(listings, outlets)


# --- persisted labels, one market, views, wide numbers --------------------------------------

@register("label_persisted", oracle.with_(_LBL_CTES + [oracle.labelled_cte(SCORED_AT)], oracle.label_persisted_body(SCORED_AT, RESCORED_AT)))
def label_persisted(spark, sf_dir):
    """C4: two scoring runs appended to the review table, the second for
    half of the rows; read back from it."""
    base = shared_dir(spark, "warehouse", unique=True)
    review = _review(spark, sf_dir)
    labels.append_predictions(review, base)
    again = review.filter(F.col("file_row_number") % 2 == 0).withColumn("scored_at", F.lit(RESCORED_AT).cast("timestamp_ntz"))
    return labels.append_predictions(again, base).select(
        "market", "source_file", "file_row_number", "classification_text", "predicted_label", "manual_review_label", "scored_at")


WIDE_SQL = ("case when l_linenumber = 1 then concat(cast(l_orderkey as string), '00000000000000000000') when l_linenumber = 2 then concat('-', cast(l_partkey as string), '.5') "
            "when l_linenumber = 3 then concat(cast(l_orderkey as string), repeat('9', 38)) when l_linenumber = 4 then 'n/a' else cast(l_suppkey as string) end")
SCOPED_MARKET = "ASIA"


@register("scope_market", oracle.with_(_LBL_CTES, f"select * from scoped where market = '{SCOPED_MARKET}'"))
def scope_market(spark, sf_dir):
    """The optional market filter."""
    return labels.scope_sample(_valid_portfolio(spark, sf_dir), market=SCOPED_MARKET)


@register("model_views", oracle.with_(oracle.gold_ctes() + [oracle.DIM_MARKET_CTE], oracle.MODEL_VIEWS_BODY))
def model_views(spark, sf_dir):
    """Every model a view, queried by name in SQL."""
    lay = _layers(spark, sf_dir)
    names = layers.register_views({**{f"int_{s}_valid": df for s, df in lay.valid.items()}, **lay.gold})
    return spark.sql(" union all ".join(f"select '{n}' as model, market, count(*) as row_count from {n} group by market" for n in names))


@register("wide_numbers", f"select l_orderkey, l_linenumber, cast({oracle.casts.safe_number_sql(WIDE_SQL, 'decimal(38,0)')} as varchar) as wide from lineitem")
def wide_numbers(spark, sf_dir):
    """whole numbers beyond 64 bits, halves, too many digits, no numbers."""
    return standins.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", casts.to_text(casts.safe_number(F.expr(WIDE_SQL))).alias("wide"))


@register("partition_replace", oracle.with_(oracle.layer_ctes(("outlet",)) + [oracle.DIM_PLATFORM_CTE], oracle.PARTITION_REPLACE_BODY))
def partition_replace(spark, sf_dir):
    """Markets whose names need escaping, an empty one and none at all
    are kept apart; two are rebuilt, one of them without rows."""
    base = shared_dir(spark, "warehouse", unique=True)
    staged = conform.stg_outlets(standins.parsed_standin(spark, sf_dir, "outlet", True))
    named = dims.dim_platform(quality.split(staged, quality.OUTLET_RULES)[0]).select(
        F.when(F.col("market") == "AFRICA", "A/B=C %").when(F.col("market") == "ASIA", "").when(F.col("market") != "EUROPE", F.col("market")).alias("market"),
        "platform_key", "platform_name")
    layers.write_layer(named.withColumn("platform_name", F.lit("before")), base, "gold", "dim_platform")
    slice_ = named.filter(F.col("market") == "")
    return layers.write_layer(slice_, base, "gold", "dim_platform", only_touched_partitions=True, touched=["", "A/B=C %"])


# --- semi-structured path, lineage join, layer tables ------------------------------------

@register("json_path", "select event_id, json_extract_string(props, '$.k') as k_text, "
                       "json_extract_string(concat('{\"labels\":[\"', event_type, '\"]}'), '$.labels[0]') "
                       "as first_label from events")
def json_path(spark, sf_dir):
    ev = standins.read_table(spark, sf_dir, "events")
    doc = F.concat(F.lit('{"labels":["'), F.col("event_type"), F.lit('"]}'))
    return ev.select("event_id", F.get_json_object("props", "$.k").alias("k_text"),
                     F.get_json_object(doc, "$.labels[0]").alias("first_label"))


@register("lineage_join", "select p.*, r.raw_data as raw_record from ("
          + lineage.PARSED_SQL.format(orders="orders").replace(
              "concat(' ', lower(o_orderstatus), ' ') as market", "upper(trim(concat(' ', lower(o_orderstatus), ' '))) as market")
          + ") p left join (" + lineage.RAW_SQL["duckdb"].format(orders="orders") + ") r "
          "on p.market = upper(trim(r.market)) and p.source_file = r.source_file "
          "and p.file_row_number = r.file_row_number")
def lineage_join(spark, sf_dir):
    parsed, raw = lineage.lineage_pair(spark, sf_dir)
    return conform.attach_raw(parsed, raw)


_BOTH = {"events": "events", "region": "region"}


@register("lineage_realigned", oracle.lineage_realigned_sql(lineage.APART_PARSED_SQL.format(**_BOTH), lineage.APART_RAW_SQL["duckdb"].format(**_BOTH)))
def lineage_realigned(spark, sf_dir):
    """J1 where the two loads numbered the lines apart: shifted, missing,
    doubled, changed and moved lines find their raw text."""
    parsed, raw = lineage.loaded_apart(spark, sf_dir)
    return alignment.attach_aligned(parsed, raw, "matching").select(
        "market", "source_file", "file_row_number", "id_outlet", "id_platform", "place_id", "created_at", "raw_row_number", "raw_record", "match_kind")


@register("layer_roundtrip", oracle.with_(oracle.layer_ctes(("outlet",)) + [oracle.DIM_PLATFORM_CTE],
                                          "select * from dim_platform"))
def layer_roundtrip(spark, sf_dir):
    """Create a gold table, replace it (insert overwrite), read it back with
    the key columns first (``keys, *``)."""
    base = shared_dir(spark, "warehouse", unique=True)
    staged = conform.stg_outlets(standins.parsed_standin(spark, sf_dir, "outlet", True))
    v, _ = quality.split(staged, quality.OUTLET_RULES)
    d = dims.dim_platform(v)
    layers.write_layer(d.withColumn("platform_name", F.lit("before")), base, "gold", "dim_platform")  # must all go
    back = layers.write_layer(d, base, "gold", "dim_platform", mode="overwrite")
    keys = ["platform_key", "market_key"]
    return back.select(*keys, *[c for c in back.columns if c not in keys])


# --- ingest (files landed from the driver tables, then loaded) -----------------------------

def _land_events(spark, sf_dir, with_stray=False) -> str:
    root = shared_dir(spark, "landing", unique=True)
    landing.write_landing(landed_events.landing_rows(spark, sf_dir, with_stray), root, "matching")
    return root


def _source_dir(df: DataFrame) -> DataFrame:
    return df.withColumn("source_dir", F.regexp_replace("source_file", "[^/]*$", ""))


_PARSED_OUT = ["market", "source_dir", "file_row_number", "load_timestamp", *schemas.MATCHING_FIELDS]
_TS = landed_events.INGEST_LOAD_TS


@register("ingest_parsed", oracle.with_(oracle.landed_ctes(), oracle.ingest_parsed_body(_TS)))
def ingest_parsed(spark, sf_dir):
    load = ingest.ingest(spark, _land_events(spark, sf_dir), "matching", _TS)
    return _source_dir(load.parsed).select(*_PARSED_OUT)


@register("ingest_raw", oracle.with_(oracle.landed_ctes(), oracle.ingest_raw_body(_TS)))
def ingest_raw(spark, sf_dir):
    load = ingest.ingest(spark, _land_events(spark, sf_dir), "matching", _TS, raw_mode="record")
    return _source_dir(load.raw).select("market", "source_dir", "file_row_number", "load_timestamp", "raw_data")


@register("ingest_raw_lines", oracle.with_(oracle.landed_ctes(), oracle.ingest_lines_body(_TS)))
def ingest_raw_lines(spark, sf_dir):
    """The raw table as the raw line format reads it: no enclosure."""
    load = ingest.ingest(spark, _land_events(spark, sf_dir), "matching", _TS)
    return _source_dir(load.raw).select("market", "source_dir", "file_row_number", "load_timestamp", "raw_data")


@register("ingest_parse_issues", oracle.with_(oracle.landed_ctes(), oracle.PARSE_ISSUES_BODY))
def ingest_parse_issues(spark, sf_dir):
    """Rows with too many or too few fields, kept and reported."""
    load = ingest.ingest(spark, _land_events(spark, sf_dir, with_stray=True), "matching", _TS)
    return _source_dir(load.parse_issues).select("market", "source_dir", "file_row_number")


@register("file_reject", oracle.with_(oracle.landed_ctes()[:1], oracle.FILE_REJECT_BODY))
def file_reject(spark, sf_dir):
    load = ingest.ingest(spark, _land_events(spark, sf_dir, with_stray=True), "matching", _TS)
    return _source_dir(load.file_issues).select("source_dir", "issue")


def _drifted(spark, sf_dir):
    root = shared_dir(spark, "landing", unique=True)
    landed_events.land_drifted(spark, sf_dir, root)
    return drift.parse_by_header(ingest.land(spark, root, "matching", cut_lineage=True), "matching", _TS)


@register("ingest_drifted", oracle.with_(oracle.landed_ctes(), oracle.ingest_drifted_body(_TS)))
def ingest_drifted(spark, sf_dir):
    """Files whose columns were moved, added, dropped or renamed, bound by
    their headers."""
    return _source_dir(_drifted(spark, sf_dir)[0]).select(*_PARSED_OUT)


@register("header_drift", oracle.header_drift_body(landed_events.DRIFTED).format(bucket=landed_events.BUCKET))
def header_drift(spark, sf_dir):
    """How each file's header differs from the layout."""
    return _source_dir(_drifted(spark, sf_dir)[1]).select("source_dir", "kind", "field", "position", "found_name", "found_position")


@register("ingest_stream", oracle.with_(oracle.landed_ctes(), oracle.ingest_parsed_body(_TS)))
def ingest_stream(spark, sf_dir):
    """The same landed files loaded by the streaming ingest (availableNow)."""
    root = _land_events(spark, sf_dir)
    out = shared_dir(spark, "bronze_stream", unique=True)
    q = file_ingest.stream_bronze(spark, root, "matching", out, f"{out}/_checkpoint", load_ts=_TS, max_files_per_trigger=16)
    q.awaitTermination()
    return _source_dir(file_ingest.read_bronze(spark, out, "parsed")).select(*_PARSED_OUT)


@register("ingest_reload", oracle.with_(oracle.landed_ctes(), oracle.ingest_parsed_body(_TS)))
def ingest_reload(spark, sf_dir):
    """Half of the files are loaded, then the rest, then nothing new:
    each file is in bronze once."""
    source, warehouse = _land_events(spark, sf_dir), shared_dir(spark, "warehouse", unique=True)
    root = shared_dir(spark, "landing", unique=True)
    copied = run_layers.copy_files(spark, f"{source}/MATCHING", f"{root}/MATCHING", lambda i: i % 2 == 0)
    run_layers.load_bronze(spark, root, warehouse, _TS, sources=("matching",))
    run_layers.copy_files(spark, f"{source}/MATCHING", f"{root}/MATCHING", lambda i: i % 2 == 1)
    run_layers.load_bronze(spark, root, warehouse, _TS, sources=("matching",))
    bronze, _ = run_layers.load_bronze(spark, root, warehouse, _TS, sources=("matching",))
    assert copied
    return _source_dir(bronze["matching"]).select(*_PARSED_OUT)


# --- deliveries against deadlines -------------------------------------------------------------

def _delivery_rows(spark, sf_dir) -> DataFrame:
    """Every event is a delivery of its type for its region; each pair is due
    an hour into every quarter of a day.  ``part``: the file a row comes in;
    some rows of the last half day before a cut come a file late."""
    ev = standins.read_table(spark, sf_dir, "events").join(F.broadcast(standins.read_table(spark, sf_dir, "region")), F.expr("r_regionkey = user_id % 5"))
    start = F.expr("date_trunc('DAY', ts) + make_dt_interval(0, cast(floor(hour(ts) / 6) as int) * 6)").cast("timestamp_ntz")
    files = ev.select(F.lit("file").alias("kind"), F.col("event_type").alias("source_name"), F.upper("r_name").alias("market"), start.alias("start"),
                      F.col("ts").alias("at"), F.expr("(event_id % 13 = 0)").alias("slow"))
    quarters = files.select("start").distinct()
    pairs = files.select("source_name", "market").distinct()
    due = quarters.crossJoin(F.broadcast(pairs)).select(F.lit("due").alias("kind"), "source_name", "market", "start", F.col("start").alias("at"), F.lit(False).alias("slow"))
    came = F.expr("at + case when slow then interval 12 hours else interval 0 hours end")
    part = F.concat(F.date_format(came, "yyyy-MM"), F.least(F.floor((F.dayofmonth(came) - 1) / 10), F.lit(2)).cast("string"))
    is_due = F.col("kind") == "due"
    return files.unionByName(due).select(
        "kind", "source_name", "market", F.date_format("start", "yyyy-MM-dd HH").alias("period"), F.col("at").cast("timestamp").alias("at"),
        F.when(is_due, F.expr("start + interval 1 hour")).cast("timestamp").alias("due"),
        F.when(is_due, F.expr("start + interval 6 hours")).cast("timestamp").alias("period_end"), part.alias("part"))


@register("delivery_deadlines", oracle.DEADLINES_SQL)
def delivery_deadlines(spark, sf_dir):
    """Missed, late and absent deliveries, from timers of a stateful
    stream over the parts in their order, some rows a part late.  The stream
    is started anew for each part and goes on from its checkpoint."""
    folder = shared_dir(spark, "deliveries", unique=True)
    rows = layers.materialize(_delivery_rows(spark, sf_dir), "deliveries")
    for part in sorted(r[0] for r in rows.select("part").distinct().collect()):  # three a month
        rows.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{folder}/in")
        deadlines.watch_folder(spark, f"{folder}/in", f"{folder}/out", f"{folder}/_checkpoint", "1 day", None).awaitTermination()
    return spark.read.schema(deadlines.OUTPUT_SCHEMA).parquet(f"{folder}/out").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("due", "delivered_at")})


# --- layers kept up to date load by load -----------------------------------------------------

def _three_loads(spark, sf_dir, sources):
    """The bronze stand-ins in three loads, each in a folder of its own; the
    third also holds bad copies of rows of the first, which take those out again."""
    part = F.pmod(F.col("file_row_number"), F.lit(5))

    def written(source):
        again, column = oracle.BAD_AGAIN[source]
        numbers = F.when(part == 3, F.array(F.lit(1))).when(part == 4, F.array(F.lit(2))).when(F.expr(again), F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
        rows = standins.parsed_standin(spark, sf_dir, source).filter(part.isNotNull()).withColumn("_load", F.explode(numbers))
        rows = rows.withColumn(column, F.when((F.col("_load") == 2) & (part < 3), F.lit("")).otherwise(F.col(column)))
        return layers.materialize(rows, f"bronze-loads-{source}", ("_load",))

    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        bronze = dict(zip(sources, pool.map(written, sources), strict=True))
    return [{s: df.filter(F.col("_load") == n).drop("_load") for s, df in bronze.items()} for n in range(3)]


def _kept_up(spark, sf_dir, sources) -> deltas.Incremental:
    state = deltas.Incremental(spark, shared_dir(spark, "incremental", unique=True), sources)
    for load in _three_loads(spark, sf_dir, sources):
        state.apply(load)
    return state


@register("fact_after_loads", oracle.with_(oracle.reloaded(oracle.gold_ctes()), "select * from fct"))
def fact_after_loads(spark, sf_dir):
    """J2, W2, J4 under new loads: the fact after three loads, from the
    changes of each, equals a full rebuild."""
    return _kept_up(spark, sf_dir, standins.SOURCES).logs["fct_outlet_product_listing"].current()


@register("products_after_loads", oracle.with_(oracle.reloaded(oracle.layer_ctes(("portfolio",)) + [oracle.DIM_PRODUCT_CTE], ("portfolio",)), "select * from dim_product"))
def products_after_loads(spark, sf_dir):
    return _kept_up(spark, sf_dir, ("portfolio",)).logs["dim_product"].current()



@register("layer_counts", oracle.with_(oracle.gold_ctes(), oracle.layer_counts_body()))
def layer_counts(spark, sf_dir):
    bronze = _bronze(spark, sf_dir, with_raw=False)
    lay = build.build(bronze, _scope(spark, sf_dir))
    return monitoring.layer_counts({
        "bronze": bronze, "valid": lay.valid, "rejected": lay.rejected,
        "gold": {"portfolio": lay.gold["fct_outlet_product_listing"]}})


@register("reject_trend", oracle.with_(oracle.layer_ctes(valid=False), oracle.REJECT_TREND_BODY))
def reject_trend(spark, sf_dir):
    staged = build.silver(_bronze(spark, sf_dir))
    return monitoring.reject_trend({s: quality.rejected(df, quality.RULES[s]) for s, df in staged.items()})


@register("join_coverage", oracle.with_(oracle.gold_ctes(), oracle.JOIN_COVERAGE_BODY))
def join_coverage(spark, sf_dir):
    lay = _layers(spark, sf_dir, materialized=())
    return monitoring.join_coverage(lay.valid["portfolio"], lay.gold["dim_outlet"])


# Fixed values of the registered freshness run.
FRESHNESS_AS_OF, FRESHNESS_MAX_HOURS = "2024-06-02 06:00:00", 24.0


@register("freshness", oracle.with_(oracle.bronze_ctes_raw(),
                                    oracle.freshness_body(FRESHNESS_AS_OF, FRESHNESS_MAX_HOURS)))
def freshness(spark, sf_dir):
    return monitoring.freshness(_bronze(spark, sf_dir, with_raw=False), FRESHNESS_AS_OF, FRESHNESS_MAX_HOURS)


# Rows created before the cutoff were scored by an earlier run; a share of
# them has changed text since.
SCORE_CUTOFF = "1998-06-01 00:00:00"


@register("score_incremental", oracle.with_(_LBL_CTES, oracle.score_incremental_body(SCORE_CUTOFF)))
def score_incremental(spark, sf_dir):
    valid = _valid_portfolio(spark, sf_dir)
    scoped = labels.scope_sample(valid, n=None)
    earlier = valid.filter(F.col("created_at") < F.lit(SCORE_CUTOFF).cast("timestamp_ntz"))
    prev = (labels.scope_sample(earlier, n=None)
            .select("market", "source_file", "file_row_number",
                    F.when(F.col("file_row_number") % 7 == 0,
                           F.concat("classification_text", F.lit(" (old)")))
                    .otherwise(F.col("classification_text")).alias("classification_text")))
    return monitoring.to_score(scoped, prev)


# Reviewer labels of the registered run: the categories a reviewer has
# settled (others are not reviewed yet).
MANUAL_SQL = ("case when menu_category = 'Drinks' then 'standalone_drink' "
              "when menu_category in ('Burgers', 'Fingerfood') then 'meal_or_combo_with_drink' end")


@register("review_metrics", oracle.with_(_LBL_CTES + [oracle.labelled_cte(SCORED_AT)],
                                         oracle.review_metrics_body(MANUAL_SQL)))
def review_metrics(spark, sf_dir):
    review = _review(spark, sf_dir).withColumn("manual_review_label", F.expr(MANUAL_SQL))
    return monitoring.review_metrics(review)


@register("dim_history", oracle.with_(oracle.layer_ctes(("portfolio",)) + [oracle.HISTORY_CTE], oracle.DIM_HISTORY_BODY))
def dim_history(spark, sf_dir):
    return monitoring.dim_history(_valid_portfolio(spark, sf_dir))


@register("lineage_fingerprint", oracle.with_([oracle.bronze_cte("matching"), oracle.stg_cte("matching")],
                                              "select market, source_file, file_row_number, "
                                              "sha256(raw_record) as raw_fingerprint from stg_matching"))
def lineage_fingerprint(spark, sf_dir):
    staged = conform.stg_matching(standins.parsed_standin(spark, sf_dir, "matching", True))
    return monitoring.lineage_fingerprint(staged)


INCREMENTAL_MARKET = "EUROPE"


@register("incremental_gold", oracle.with_(oracle.layer_ctes(("outlet",)) + [oracle.DIM_PLATFORM_CTE],
                                           "select * from dim_platform"))
def incremental_gold(spark, sf_dir):
    """A gold table in which one market is out of date and one is left
    over; both are rebuilt from their bronze slice (the second has none) and
    only their partitions are replaced; the table must equal a full rebuild."""
    base = shared_dir(spark, "warehouse", unique=True)
    bronze = standins.parsed_standin(spark, sf_dir, "outlet", True)
    def platform(b):
        staged = conform.stg_outlets(b)
        return dims.dim_platform(quality.split(staged, quality.OUTLET_RULES)[0])
    now = platform(bronze)
    stale = F.when(F.col("market") == INCREMENTAL_MARKET, F.lit("before")).otherwise(F.col("platform_name"))
    gone = now.filter(F.col("market") == INCREMENTAL_MARKET).withColumn("market", F.lit("CLOSED"))
    layers.write_layer(now.withColumn("platform_name", stale).unionByName(gone), base, "gold", "dim_platform")
    touched = [INCREMENTAL_MARKET, "CLOSED"]
    slice_ = bronze.filter(F.upper(F.trim("market")).isin(touched))
    return layers.write_layer(platform(slice_), base, "gold", "dim_platform",
                              only_touched_partitions=True, touched=touched)



@register("dim_drink", oracle.with_(oracle.layer_ctes(("portfolio",)), oracle.DIM_DRINK_BODY))
def dim_drink(spark, sf_dir):
    """Drink-level dimension next to the beverage-level dim_product."""
    return dims.dim_drink(_valid_portfolio(spark, sf_dir))


@register("bridge_beverage_drink", oracle.with_(oracle.layer_ctes(("portfolio",)), oracle.BRIDGE_BODY))
def bridge_beverage_drink(spark, sf_dir):
    """Which drink each beverage (size variant) belongs to."""
    return dims.bridge_beverage_drink(_valid_portfolio(spark, sf_dir))



ALLOWED_SEGMENT = ("EUROPE", "pharmacy")  # the registered run's market exception


def _allowlist(spark, sf_dir):
    m, v = ALLOWED_SEGMENT
    return (standins.read_table(spark, sf_dir, "region")
            .filter(F.upper(F.trim("r_name")) == F.lit(m))
            .select(F.upper(F.trim("r_name")).alias("market"),
                    F.lit(quality.INVALID_SEGMENT_TYPE[0]).alias("error_code"), F.lit(v).alias("value")))


@register("reject_exceptions", oracle.with_(
    oracle.layer_ctes(("outlet",), valid=False)
    + [f"allow as (select upper(trim(r_name)) as market, 'INVALID_SEGMENT_TYPE' as error_code, "
       f"'{ALLOWED_SEGMENT[1]}' as value from region where upper(trim(r_name)) = '{ALLOWED_SEGMENT[0]}')"],
    "select r.market, r.source_file, r.file_row_number, r.error_code, 'reject' as severity, "
    "exists (select 1 from allow a where a.market = r.market and a.error_code = r.error_code and "
    "a.value = case when r.error_code = 'INVALID_SEGMENT_TYPE' then r.segment_type end) as allowlisted "
    "from rej_outlet r"))
def reject_exceptions(spark, sf_dir):
    """Outlet rejects with severity and a per-market allowlist."""
    staged = conform.stg_outlets(standins.parsed_standin(spark, sf_dir, "outlet", True))
    _, flagged = quality.split_with_exceptions(staged, quality.OUTLET_RULES, _allowlist(spark, sf_dir))
    return flagged.select("market", "source_file", "file_row_number", "error_code", "severity", "allowlisted")
