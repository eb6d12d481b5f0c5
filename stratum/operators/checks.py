"""Declarative data-quality checks.

A check counts failing rows the way the declared tests do:

* ``not_null``            rows where the column is NULL
* ``unique``              non-NULL values that occur more than once
* ``unique_combination``  column combinations that occur more than once
* ``accepted_values``     distinct non-NULL values outside the list
* ``relationships``       child rows with a non-NULL key missing in the parent
* ``custom``              rows returned by an arbitrary failing-rows DataFrame

``run_checks`` evaluates a suite into one row per check (name, model,
column, severity, failures, status).  Every count is a distributed
aggregate; the not-NULL checks of one model share a single pass
(``count_if`` per column) and nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["check_name", "model", "column_name", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple[str, ...] = ()
    parent: str | None = None          # relationships: parent model
    parent_column: str | None = None
    name: str | None = field(default=None)

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        cols = "__".join(self.columns)
        target = f"__{self.parent}__{self.parent_column}" if self.kind == "relationships" else ""
        return f"{self.kind}__{self.model}__{cols}{target}"


def not_null(model, column, severity="error"):
    return Check("not_null", model, (column,), severity)


def unique(model, column, severity="error"):
    return Check("unique", model, (column,), severity)


def unique_combination(model, columns, severity="error"):
    return Check("unique_combination", model, tuple(columns), severity)


def accepted_values(model, column, values, severity="error"):
    return Check("accepted_values", model, (column,), severity, values=tuple(values))


def relationships(model, column, parent, parent_column, severity="error"):
    return Check("relationships", model, (column,), severity, parent=parent, parent_column=parent_column)


def custom(name, model, severity="warn"):
    return Check("custom", model, (), severity, name=name)


# --- failure counts ---------------------------------------------------------------

def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures"))


def _failures(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The number of failing rows.  Relationship checks reduce the child to
    one row per key first: few keys, however many rows, meet the parent."""
    if check.kind != "relationships":
        return _count(failing_rows(check, tables))
    c = check.columns[0]
    keys = tables[check.model].filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    parent = tables[check.parent].select(F.col(check.parent_column).alias(c))
    return keys.join(parent, c, "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The failing rows of one check (the query a declared test runs)."""
    df = tables[check.model]
    if check.kind == "not_null":
        return df.filter(F.col(check.columns[0]).isNull())
    if check.kind == "unique":
        c = check.columns[0]
        return df.filter(F.col(c).isNotNull()).groupBy(c).count().filter(F.col("count") > 1)
    if check.kind == "unique_combination":
        return df.groupBy(*check.columns).count().filter(F.col("count") > 1)
    if check.kind == "accepted_values":
        c = check.columns[0]
        return df.select(c).distinct().filter(~F.col(c).isin(*check.values))
    if check.kind == "relationships":
        c = check.columns[0]
        parent = tables[check.parent].select(F.col(check.parent_column).alias(c)).distinct()
        return df.filter(F.col(c).isNotNull()).select(c).join(parent, c, "left_anti")
    if check.kind == "custom":
        return df
    raise ValueError(f"unknown check kind {check.kind}")


def _labelled(counts: DataFrame, check: Check) -> DataFrame:
    return counts.select(F.lit(check.check_name).alias("check_name"), F.lit(check.model).alias("model"),
                         F.lit(",".join(check.columns)).alias("column_name"),
                         F.lit(check.severity).alias("severity"), F.col("failures").cast("bigint"))


def _batch_failures(c: Check):
    """Aggregate expression giving one check's failures inside a shared pass."""
    col = F.col(c.columns[0])
    if c.kind == "not_null":
        return F.count_if(col.isNull())
    # accepted_values: distinct non-NULL values outside the list
    return F.count_distinct(F.when(~col.isin(*c.values), col))


def _model_batch(model: str, checks: list[Check], df: DataFrame) -> DataFrame:
    """All NOT NULL and accepted-values checks of a model in one scan
    (one aggregate, unpivoted to one row per check)."""
    agg = df.agg(*[_batch_failures(c).alias(f"f{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.check_name).alias("check_name"),
                              F.lit(",".join(c.columns)).alias("column_name"),
                              F.lit(c.severity).alias("severity"),
                              F.col(f"f{i}").cast("bigint").alias("failures"))
                     for i, c in enumerate(checks)])
    return (agg.select(F.explode(rows).alias("r"))
            .select("r.check_name", F.lit(model).alias("model"), "r.column_name", "r.severity",
                    "r.failures"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Balanced union: each step analyses a plan of logarithmic depth
    instead of re-analysing an ever longer chain."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


BATCHED = ("not_null", "accepted_values")


def run_checks(suite: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: failures and status (pass / warn / fail)."""
    parts = []
    by_model: dict[str, list[Check]] = {}
    for c in suite:
        if c.kind in BATCHED:
            by_model.setdefault(c.model, []).append(c)
        else:
            parts.append(_labelled(_failures(c, tables), c))
    for model, checks in by_model.items():
        parts.append(_model_batch(model, checks, tables[model]))
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return union_all(parts).withColumn("status", status).select(*RESULT_COLUMNS)


# --- the declared suite of the listing model ------------------------------------

KEY_COLS = ("market", "source_file", "file_row_number")


def declared_suite(markets: tuple[str, ...]) -> list[Check]:
    """The checks declared on the silver, intermediate and gold models."""
    s: list[Check] = []
    for m in ("stg_outlets", "stg_portfolio", "stg_matching"):
        s.append(unique_combination(m, KEY_COLS))
        s += [not_null(m, "market"), accepted_values(m, "market", markets),
              not_null(m, "source_file"), not_null(m, "file_row_number"), not_null(m, "load_timestamp")]
    for m, col in (("int_outlets_valid", "created_at"), ("int_portfolio_valid", "item_price"),
                   ("int_matching_valid", "created_at")):
        s.append(unique_combination(m, KEY_COLS))
        s += [not_null(m, c) for c in ("market", "source_file", "file_row_number", col)]
    for m in ("int_outlets_rejected", "int_portfolio_rejected", "int_matching_rejected"):
        s += [not_null(m, "error_code"), not_null(m, "error_reason")]
    s += [not_null("dim_market", "market_key"), unique("dim_market", "market_key"),
          not_null("dim_market", "market"), unique("dim_market", "market")]
    s += [not_null("dim_platform", "platform_key"), unique("dim_platform", "platform_key"),
          not_null("dim_platform", "market_key"),
          relationships("dim_platform", "market_key", "dim_market", "market_key"),
          not_null("dim_platform", "id_platform")]
    s += [not_null("dim_outlet", "outlet_key"), unique("dim_outlet", "outlet_key"),
          not_null("dim_outlet", "market_key"),
          relationships("dim_outlet", "market_key", "dim_market", "market_key"),
          not_null("dim_outlet", "platform_key"),
          relationships("dim_outlet", "platform_key", "dim_platform", "platform_key"),
          not_null("dim_outlet", "id_outlet"), not_null("dim_outlet", "id_ext_link"),
          not_null("dim_outlet", "id_platform")]
    s += [not_null("dim_product", "product_key"), unique("dim_product", "product_key"),
          not_null("dim_product", "market_key"),
          relationships("dim_product", "market_key", "dim_market", "market_key"),
          not_null("dim_product", "id_beverage")]
    f = "fct_outlet_product_listing"
    s += [not_null(f, "listing_key"), unique(f, "listing_key"), not_null(f, "market_key"),
          relationships(f, "market_key", "dim_market", "market_key"),
          not_null(f, "outlet_key"), relationships(f, "outlet_key", "dim_outlet", "outlet_key"),
          not_null(f, "product_key"), relationships(f, "product_key", "dim_product", "product_key"),
          not_null(f, "item_price")]
    s.append(custom("warn_on_missing_source_coverage", "missing_source_coverage", "warn"))
    return s
