import datetime as dt

from helpers import bronze

from stratum.operators import conform, dims, labels, monitoring, quality


def _valid(spark, source, rows):
    staged = conform.STAGERS[source](bronze(spark, source, rows))
    return quality.split(staged, quality.RULES[source])


def test_layer_counts_and_reject_trend(spark):
    b = bronze(spark, "portfolio", [{"item_price": "1"}, {"item_price": None}, {"item_price": "x"}])
    v, r = _valid(spark, "portfolio", [{"item_price": "1"}, {"item_price": None}, {"item_price": "x"}])
    row = monitoring.layer_counts({"bronze": {"portfolio": b}, "valid": {"portfolio": v},
                                   "rejected": {"portfolio": r}}).collect()[0]
    assert (row.bronze_rows, row.valid_rows, row.rejected_rows, row.gold_rows) == (3, 1, 2, 0)
    trend = monitoring.reject_trend({"portfolio": r}).collect()
    assert [(t.error_code, t.rejected_rows, t.load_period) for t in trend] == [
        ("MISSING_ITEM_PRICE", 2, dt.datetime(2024, 6, 1))]


def test_join_coverage_ignores_duplicate_outlets(spark):
    ok = {"created_at": "2024-01-01", "segment_type": "restaurant", "id_outlet": "1"}
    outlets, _ = _valid(spark, "outlet", [dict(ok, id_ext_link="L1"), dict(ok, id_ext_link="L1")])
    matching, _ = _valid(spark, "matching", [])
    port, _ = _valid(spark, "portfolio", [
        {"id_beverage": "b", "id_outlet": "1", "id_ext_link": "L1", "item_price": "1"},
        {"id_beverage": "b", "id_outlet": "1", "id_ext_link": "L9", "item_price": "1"}])
    row = monitoring.join_coverage(port, dims.dim_outlet(outlets, matching)).collect()[0]
    assert (row.listings, row.matched_listings, row.coverage_rate) == (2, 1, 0.5)


def test_freshness_threshold(spark):
    b = bronze(spark, "outlet", [{}])
    fresh = monitoring.freshness({"outlet": b}, "2024-06-01 12:00:00", 24).collect()[0]
    stale = monitoring.freshness({"outlet": b}, "2024-06-03 00:00:00", 24).collect()[0]
    assert (fresh.age_hours, fresh.freshness_status) == (12.0, "fresh")
    assert (stale.age_hours, stale.freshness_status) == (48.0, "stale")


def test_incremental_scoring_new_and_changed(spark):
    scoped = spark.createDataFrame([("USA", "f", i, f"text{i}") for i in range(5)],
                                   "market string, source_file string, file_row_number long, "
                                   "classification_text string")
    prev = spark.createDataFrame([("USA", "f", 0, "text0"), ("USA", "f", 1, "changed")],
                                 "market string, source_file string, file_row_number long, "
                                 "classification_text string")
    todo = sorted(r.file_row_number for r in monitoring.to_score(scoped, prev).collect())
    assert todo == [1, 2, 3, 4]
    capped = monitoring.to_score(scoped, prev, budget=2).collect()
    assert len(capped) == 2


def test_review_metrics(spark):
    review = spark.createDataFrame([
        ("USA", labels.MEAL, labels.MEAL), ("USA", labels.MEAL, labels.STANDALONE),
        ("USA", labels.UNCLEAR, None), ("USA", labels.STANDALONE, labels.MEAL)],
        "market string, predicted_label string, manual_review_label string")
    r = monitoring.review_metrics(review).collect()[0]
    assert (r.scored_rows, r.reviewed_rows) == (4, 3)
    assert (r.agreement_rate, r.precision_positive, r.recall_positive, r.review_rate) == (
        round(1 / 3, 6), 0.5, 0.5, 0.25)


def test_dim_history_collapses_unchanged_versions(spark):
    v, _ = _valid(spark, "portfolio", [
        {"id_beverage": "b", "item_price": "1", "item_name": "can", "created_at": "2024-01-01"},
        {"id_beverage": "b", "item_price": "1", "item_name": "can", "created_at": "2024-02-01"},
        {"id_beverage": "b", "item_price": "1", "item_name": "bottle", "created_at": "2024-03-01"}])
    rows = sorted(monitoring.dim_history(v).collect(), key=lambda r: r.valid_from)
    assert [(r.item_name, r.valid_from.month, r.valid_to and r.valid_to.month, r.is_current) for r in rows] == [
        ("can", 1, 3, False), ("bottle", 3, None, True)]
