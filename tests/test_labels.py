from stratum.operators import labels

COLS = ("market string, source_file string, file_row_number long, id_outlet string, id_beverage string, "
        "id_drink string, item_name string, addon_text string, menu_category string, "
        "drink_category_primary string, drink_category_secondary string, item_description string, "
        "item_price double, item_brand string, item_subbrand string, has_addon_prompt boolean")

# The four worked examples of the reference's labelling notebook.
EXAMPLES = [
    ("Volt 250ml", "", "Drinks", "Energy Drinks", "Volt", "250ml can", 2.99, "Volt",
     "Volt Energy Drink", False, labels.STANDALONE),
    ("Cheeseburger Menu", "choose your drink", "Burgers", "Soft Drinks", "Cola", "burger, fries and a drink",
     10.90, "Cola Co", "Cola Unspecified", True, labels.MEAL),
    ("L.A. Chicken-Crossies (8 Stuck)", "Cola Zero 1.0l reusable", "Fingerfood", "Soft Drink", "Cola",
     "crispy chicken snack with selectable drink", 8.90, "Cola Co", "Cola Zero", True, labels.MEAL),
    ("Family Box", "optional drink selection", "Specials", "", "", "large sharing menu with optional drink add-on",
     24.90, "Lemon Co", "Lemon Unspecified", True, labels.UNCLEAR),
]


def _frame(spark, rows):
    return spark.createDataFrame([("GBR", "f", i, "o", "b", "d", *r) for i, r in enumerate(rows)], COLS)


def test_reference_examples(spark):
    df = _frame(spark, [e[:-1] for e in EXAMPLES] + [(None, None, None, None, None, None, None, None, None, None),
                                                     (None, "water 0.5l", None, None, None, None, None, None,
                                                      None, None)])
    scoped = labels.scope_sample(df, n=None)
    out = {r.file_row_number: r.predicted_label for r in labels.label(scoped).collect()}
    assert 4 not in out  # neither name nor addon text: out of scope
    assert [out[i] for i in range(4)] == [e[-1] for e in EXAMPLES]
    assert out[5] == labels.UNCLEAR


def test_classification_text_is_null_safe(spark):
    df = _frame(spark, [(None, "x", None, None, None, None, None, None, None, None)])
    text = labels.scope_sample(df, n=None).collect()[0].classification_text
    assert text.startswith("ITEM_NAME:  | ADDON_TEXT: x | MENU_CATEGORY: ")
    assert text.endswith("HAS_ADDON_PROMPT: ")
    ex = _frame(spark, [EXAMPLES[1][:-1]])
    assert "ITEM_PRICE: 10.9 |" in labels.scope_sample(ex, n=None).collect()[0].classification_text
    assert "HAS_ADDON_PROMPT: true" in labels.scope_sample(ex, n=None).collect()[0].classification_text


def test_scorer_only_sees_undecided_rows(spark):
    from pyspark.sql import functions as F
    df = _frame(spark, [e[:-1] for e in EXAMPLES] + [("mystery", None, None, None, None, None, None, None,
                                                       None, None)])
    seen = []

    def scorer(text_col):
        seen.append(1)
        return F.when(text_col.contains("mystery"), F.lit(labels.STANDALONE))

    out = {r.file_row_number: (r.predicted_label, r.rule_id)
           for r in labels.label(labels.scope_sample(df, n=None), scorer=scorer).collect()}
    assert out[4] == (labels.STANDALONE, "scorer")
    assert out[0] == (labels.STANDALONE, "drink_category")


def test_sample_review_and_reports(spark):
    df = _frame(spark, [e[:-1] for e in EXAMPLES] * 5)
    sample = labels.scope_sample(df, n=7)
    assert sample.count() == 7
    assert sorted(r.file_row_number for r in sample.collect()) == sorted(
        r.file_row_number for r in labels.scope_sample(df, n=7).collect())  # deterministic
    review = labels.to_review_table(labels.label(labels.scope_sample(df, n=None)), "2024-01-01 00:00:00")
    assert {"manual_review_label", "manual_review_notes", "scored_at"} <= set(review.columns)
    counts = [tuple(r) for r in labels.label_counts(review).collect()]
    assert counts[0] == (labels.MEAL, 10)
    assert labels.recent(review, 3).count() == 3


def test_whole_words_addons_and_drink_kinds(spark):
    rows = [("Mexican rice bowl", None, None, None), ("Candy bar", None, None, None), ("Margherita", "choose your drink", None, None),
            ("Fizz", None, None, "Soft Drinks"), ("Sparkling 0.5 l", None, None, None), ("Canteen special", None, None, None)]
    df = _frame(spark, [(n, a, c, k, None, None, 1.0, None, None, False) for n, a, c, k in rows])
    out = {r.file_row_number: r.predicted_label for r in labels.label(labels.scope_sample(df)).collect()}
    assert [out[i] for i in range(6)] == [labels.MEAL, labels.UNCLEAR, labels.MEAL, labels.STANDALONE, labels.STANDALONE, labels.UNCLEAR]


def test_persisted_predictions_are_not_scored_again(spark, tmp_dir):
    from stratum.operators import monitoring

    rows = [e[:-1] for e in EXAMPLES]
    first = labels.scope_sample(_frame(spark, rows[:2]))
    table = labels.append_predictions(labels.to_review_table(labels.label(first), "2024-01-01 00:00:00"), tmp_dir)
    todo = monitoring.to_score(labels.scope_sample(_frame(spark, rows)), table)
    assert sorted(r.file_row_number for r in todo.collect()) == [2, 3]
    table = labels.append_predictions(labels.to_review_table(labels.label(todo), "2024-01-02 00:00:00"), tmp_dir)
    assert table.count() == 4 and monitoring.to_score(labels.scope_sample(_frame(spark, rows)), table).count() == 0
    assert [r.item_name for r in labels.recent(table, 2).collect()] == [rows[2][0], rows[3][0]]
