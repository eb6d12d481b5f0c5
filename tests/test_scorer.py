"""The optional label scorer hook with curated patterns."""
from stratum.operators import labels

COLS = ("market string, source_file string, file_row_number long, id_outlet string, id_beverage string, "
        "id_drink string, item_name string, addon_text string, menu_category string, "
        "drink_category_primary string, drink_category_secondary string, item_description string, "
        "item_price double, item_brand string, item_subbrand string, has_addon_prompt boolean")


def test_pattern_scorer_only_for_undecided(spark):
    scorer = labels.pattern_scorer([("mystery", labels.STANDALONE), ("not a label", "bogus")])
    rows = [("GBR", "f", 0, "o", "b", "d", "Cola 330ml can", None, "Drinks", None, None, None, 1.0, None, None, False),
            ("GBR", "f", 1, "o", "b", "d", "Mystery item", None, None, None, None, None, 1.0, None, None, False),
            ("GBR", "f", 2, "o", "b", "d", "thing", None, None, None, None, None, 1.0, None, None, False)]
    df = spark.createDataFrame(rows, COLS)
    out = {r.file_row_number: (r.predicted_label, r.rule_id)
           for r in labels.label(labels.scope_sample(df, n=None), scorer=scorer).collect()}
    assert out[0] == (labels.STANDALONE, "drink_category")
    assert out[1] == (labels.STANDALONE, "scorer")
    assert out[2] == (labels.UNCLEAR, labels.NO_RULE)
