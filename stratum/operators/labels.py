"""Listing labels (C1-C5): standalone drink, meal/combo with drink, or unclear.

The hosted-model call of the reference is re-aimed as a transparent rule
ladder of regular expressions evaluated on the JVM (``rlike``), the
"cheap rules first" path the reference itself recommends.  Rows no rule
decides can be given to an optional scorer, a column function of their text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import layers

# The closed label set.
STANDALONE = "standalone_drink"
MEAL = "meal_or_combo_with_drink"
UNCLEAR = "unclear_needs_review"
LABELS = (STANDALONE, MEAL, UNCLEAR)

# Fixed values: (text label, column) parts of the classification text.
TEXT_PARTS = (
    ("ITEM_NAME: ", "item_name"),
    (" | ADDON_TEXT: ", "addon_text"),
    (" | MENU_CATEGORY: ", "menu_category"),
    (" | DRINK_CATEGORY_PRIMARY: ", "drink_category_primary"),
    (" | DRINK_CATEGORY_SECONDARY: ", "drink_category_secondary"),
    (" | ITEM_DESCRIPTION: ", "item_description"),
    (" | ITEM_PRICE: ", "item_price"),
    (" | BRAND: ", "item_brand"),
    (" | SUBBRAND: ", "item_subbrand"),
    (" | HAS_ADDON_PROMPT: ", "has_addon_prompt"),
)

LISTING_COLUMNS = ["market", "source_file", "file_row_number", "id_outlet", "id_beverage", "id_drink",
                   "item_name", "addon_text", "menu_category", "drink_category_primary",
                   "drink_category_secondary", "item_description", "item_price", "item_brand",
                   "item_subbrand", "has_addon_prompt"]

# Our rule vocabulary: whole words of the lower-cased text.
OPTIONAL_PATTERN = r"\boptional\b"
MEAL_PATTERN = (r"\b(menus?|menü|combos?|box|bucket|bundle|meals?|burgers?|[a-z]*burger|pizzas?|fries|snacks?|sandwich(es)?|"
                r"wraps?|chicken|fingerfood|nuggets|kebab|pasta|salads?|rice|bowls?)\b")
# An add-on that lets the customer pick a drink belongs to a meal.
PICK_PATTERN = r"\b(choose|select|pick|choice of|add)\b.*\b(drinks?|beverages?|sodas?|cola)\b"
DRINK_CATEGORY_PATTERN = r"\b(([a-z]+ )?drinks?|beverages?|getr.nke?|boissons?|bebidas?)\b"
DRINK_NAME_PATTERN = r"\b[0-9]+([.,][0-9]+)? ?(ml|cl|l)\b|\b(cans?|bottles?|dose|flasche)\b"


@dataclass(frozen=True)
class LabelRule:
    rule_id: str
    label: str
    columns: tuple[str, ...]
    pattern: str  # matched (anywhere) in the lower-cased column text

    def column(self) -> Column:
        hits = [F.lower(F.coalesce(F.col(c), F.lit(""))).rlike(self.pattern) for c in self.columns]
        out = hits[0]
        for h in hits[1:]:
            out = out | h
        return out

    def sql(self) -> str:
        """Same predicate as ANSI SQL text for the oracle."""
        return "(" + " or ".join(f"regexp_matches(lower(coalesce({c}, '')), '{self.pattern}')"
                                 for c in self.columns) + ")"


RULES = [
    LabelRule("optional_drink", UNCLEAR, ("addon_text", "item_description"), OPTIONAL_PATTERN),
    LabelRule("meal_words", MEAL, ("item_name", "menu_category", "item_description"), MEAL_PATTERN),
    LabelRule("pick_a_drink", MEAL, ("addon_text",), PICK_PATTERN),
    LabelRule("drink_category", STANDALONE, ("menu_category",), DRINK_CATEGORY_PATTERN),
    LabelRule("drink_name", STANDALONE, ("item_name",), DRINK_NAME_PATTERN),
    LabelRule("drink_kind", STANDALONE, ("drink_category_primary", "drink_category_secondary"), DRINK_CATEGORY_PATTERN),
]
NO_RULE = "no_rule"


def classification_text(df: DataFrame) -> Column:
    """Labelled concatenation; every part COALESCEd so NULL never voids it."""
    parts = []
    for label, col in TEXT_PARTS:
        parts += [F.lit(label), F.coalesce(F.col(col).cast("string"), F.lit(""))]
    return F.concat(*parts)


def scope_sample(valid_portfolio: DataFrame, market: str | None = None, n: int | None = None) -> DataFrame:
    """Rows in scope (optional market, item name or addon text present),
    then a deterministic sample of ``n`` (top-n by a hash of the row key:
    each task keeps n rows, no global sort).  ``n=None`` keeps every row."""
    df = valid_portfolio
    if market is not None:
        df = df.filter(F.col("market") == F.lit(market))
    df = (df.filter(F.coalesce("item_name", "addon_text").isNotNull())
          .select(*LISTING_COLUMNS)
          .withColumn("classification_text", classification_text(valid_portfolio)))
    if n is None:
        return df
    return df.orderBy(*sample_order()).limit(n)


# Rows may share a row key (a file re-landed), so every order that feeds a
# limit ends with the full row content: the result never depends on ties.
TIE_BREAK = ["classification_text", "id_beverage", "id_outlet", "id_drink"]


def sample_order(columns=None):
    """Stable pseudo-random order: hash of the row key, then the row itself
    (the tie-break columns that ``columns`` has, when given)."""
    h = F.md5(F.concat_ws("|", "market", "source_file", F.col("file_row_number").cast("string")))
    tail = [c for c in TIE_BREAK if columns is None or c in columns]
    return [h] + [F.col(c).asc_nulls_last() for c in ["market", "source_file", "file_row_number", *tail]]


def _verdict() -> Column:
    expr = None
    for r in RULES:
        pair = F.struct(F.array(F.lit(r.label)).alias("labels"), F.lit(r.rule_id).alias("rule_id"))
        expr = F.when(r.column(), pair) if expr is None else expr.when(r.column(), pair)
    return expr.otherwise(F.struct(F.array(F.lit(UNCLEAR)).alias("labels"), F.lit(NO_RULE).alias("rule_id")))


def label(df: DataFrame, scorer=None) -> DataFrame:
    """Add ``predicted_label`` and ``rule_id``.

    The ladder yields a {labels: [label], rule_id} object; the label is read
    with a path + index (``labels[0]``).  ``scorer`` (a Column function of the
    classification text returning a label or NULL) decides what no rule did,
    in the same pass: its branch is only evaluated for such rows.
    """
    out = df.withColumn("_verdict", _verdict())
    out = (out.withColumn("predicted_label", F.col("_verdict.labels")[0])
           .withColumn("rule_id", F.col("_verdict.rule_id")).drop("_verdict"))
    if scorer is None:
        return out
    out = out.withColumn("_score", F.when(F.col("rule_id") == NO_RULE, scorer(F.col("classification_text"))))
    known = F.col("_score").isin(*LABELS)
    return (out.withColumn("predicted_label", F.when(known, F.col("_score")).otherwise(F.col("predicted_label")))
            .withColumn("rule_id", F.when(known, F.lit("scorer")).otherwise(F.col("rule_id"))).drop("_score"))


def to_review_table(labelled: DataFrame, scored_at) -> DataFrame:
    """C4: predictions with empty review columns and the scoring time."""
    ts = scored_at if isinstance(scored_at, Column) else F.lit(scored_at).cast("timestamp_ntz")
    return labelled.select(*LISTING_COLUMNS, "classification_text", "predicted_label", "rule_id",
                           F.lit(None).cast("string").alias("manual_review_label"),
                           F.lit(None).cast("string").alias("manual_review_notes"),
                           ts.alias("scored_at"))


def label_counts(review: DataFrame) -> DataFrame:
    """Histogram of labels, most frequent first."""
    return (review.groupBy("predicted_label").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.col("row_count").desc(), "predicted_label"))


def recent(review: DataFrame, n: int | None = None) -> DataFrame:
    """The n most recently scored rows (row key breaks ties: scored_at is
    one value per run).  Planned as TakeOrderedAndProject."""
    order = [F.col("scored_at").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ["market", "source_file", "file_row_number", *TIE_BREAK]]
    ordered = review.orderBy(*order)
    return ((ordered if n is None else ordered.limit(n))
            .select("market", "item_name", "addon_text", "menu_category", "drink_category_primary",
                    "drink_category_secondary", "item_price", "predicted_label"))


def pattern_scorer(patterns: list[tuple[str, str]]):
    """A scorer for ``label(..., scorer=)``: the label of the first (regex,
    label) whose regex matches the lower-cased classification text, else NULL;
    e.g. reviewer-curated phrases for the rows the rules leave undecided."""
    def score(text: Column) -> Column:
        out = F.lit(None).cast("string")
        for pattern, lbl in reversed([p for p in patterns if p[1] in LABELS]):
            out = F.when(F.lower(text).rlike(pattern), F.lit(lbl)).otherwise(out)
        return out

    return score


REVIEW_TABLE = "MENU_ITEM_LABELS"


def append_predictions(review: DataFrame, base: str) -> DataFrame:
    """C4: append a scoring run to the AUDIT review table; the whole table.
    The run is evaluated before the table is written, so it may read it."""
    return layers.write_layer(layers.materialize(review, "scored"), base, "audit", REVIEW_TABLE, mode="append")


def read_predictions(spark: SparkSession, base: str, schema) -> DataFrame | None:
    """The review table, or None before the first run."""
    path = layers.table_path(base, "audit", REVIEW_TABLE)
    if not layers.exists(spark, path):
        return None
    return layers.from_folders(spark.read.schema(schema).parquet(path), schema.fieldNames(), ("market",))
