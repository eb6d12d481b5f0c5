import datetime as dt

import pytest

from stratum.operators import quality

TS = dt.datetime(2024, 1, 1)
OUT_SCHEMA = ("market string, source_file string, file_row_number long, created_at timestamp_ntz, "
              "segment_type string, raw_record string, load_timestamp timestamp_ntz")


def _outlets(spark, rows):
    return spark.createDataFrame(rows, OUT_SCHEMA)


def test_outlet_rule_order_and_not_in_semantics(spark):
    df = _outlets(spark, [
        ("USA", "f", 1, None, "pharmacy", "r1", TS),      # both rules fire -> first wins
        ("USA", "f", 2, TS, None, "r2", TS),              # NULL segment -> not rejected
        ("USA", "f", 3, TS, "Restaurant", "r3", TS),      # case-sensitive -> rejected
        ("USA", "f", 4, TS, "restaurant", "r4", TS),      # accepted
    ])
    rej = {r.file_row_number: r.error_code for r in quality.rejected(df, quality.OUTLET_RULES).collect()}
    assert rej == {1: "MISSING_CREATED_AT", 3: "INVALID_SEGMENT_TYPE"}
    row = quality.rejected(df, quality.OUTLET_RULES).filter("file_row_number = 1").collect()[0]
    assert row.error_reason == quality.MISSING_CREATED_AT[1]
    assert quality.rejected(df, quality.OUTLET_RULES).columns[:7] == [
        "market", "source_file", "file_row_number", "error_code", "error_reason", "raw_record", "load_timestamp"]


def test_portfolio_without_created_at_is_valid(spark):
    df = spark.createDataFrame([("USA", "f", 1, 2.5, None, "r", TS), ("USA", "f", 2, None, TS, "r", TS)],
                               "market string, source_file string, file_row_number long, item_price double, "
                               "created_at timestamp_ntz, raw_record string, load_timestamp timestamp_ntz")
    valid, rej = quality.split(df, quality.PORTFOLIO_RULES)
    assert [r.file_row_number for r in valid.collect()] == [1]
    assert [r.error_code for r in rej.collect()] == ["MISSING_ITEM_PRICE"]


def test_split_duplicate_key_and_null_key(spark):
    df = _outlets(spark, [
        ("USA", "f", 1, TS, "restaurant", "a", TS),
        ("USA", "f", 1, None, "restaurant", "b", TS),   # same key, bad -> removes both
        (None, "f", 2, None, "restaurant", "c", TS),    # NULL market, bad -> in both outputs
        ("USA", "f", 3, TS, "restaurant", "d", TS),
    ])
    valid, rej = quality.split(df, quality.OUTLET_RULES)
    assert sorted(r.raw_record for r in valid.collect()) == ["c", "d"]
    assert sorted(r.raw_record for r in rej.collect()) == ["b", "c"]


def test_filter_split_equals_anti_join_when_keys_unique(spark):
    df = _outlets(spark, [("USA", "f", i, TS if i % 3 else None, "restaurant", str(i), TS) for i in range(30)])
    a = sorted(r.raw_record for r in quality.split(df, quality.OUTLET_RULES)[0].collect())
    b = sorted(r.raw_record for r in quality.valid_by_filter(df, quality.OUTLET_RULES).collect())
    assert a == b


def test_allowlist_and_warn_severity(spark):
    df = _outlets(spark, [
        ("USA", "f", 1, TS, "pharmacy", "a", TS),   # allowlisted in USA
        ("GBR", "f", 2, TS, "pharmacy", "b", TS),   # not allowlisted in GBR
        ("USA", "f", 3, None, "restaurant", "c", TS),
    ])
    allow = spark.createDataFrame([("USA", "INVALID_SEGMENT_TYPE", "pharmacy")],
                                  "market string, error_code string, value string")
    valid, flagged = quality.split_with_exceptions(df, quality.OUTLET_RULES, allow)
    assert sorted(r.raw_record for r in valid.collect()) == ["a"]
    rows = {r.raw_record: (r.severity, r.allowlisted) for r in flagged.collect()}
    assert rows == {"a": ("reject", True), "b": ("reject", False), "c": ("reject", False)}
    warn_rules = [quality.Rule(*quality.MISSING_CREATED_AT, lambda: __import__("pyspark.sql.functions",
                  fromlist=["col"]).col("created_at").isNull(), severity="warn")]
    valid2, flagged2 = quality.split_with_exceptions(df, warn_rules)
    assert valid2.count() == 3 and [r.severity for r in flagged2.collect()] == ["warn"]


def test_settled_split_equals_the_join_and_moves_no_rows(spark, tmp_dir):
    df = _outlets(spark, [
        ("USA", "f", 1, TS, "restaurant", "a", TS), ("USA", "f", 1, None, "restaurant", "b", TS),  # one key, good and bad
        (None, "f", 2, None, "restaurant", "c", TS), ("USA", None, 3, TS, "restaurant", "d", TS),
        ("USA", "f", 4, TS, "restaurant", "e", TS), ("USA", "f", 4, TS, "restaurant", "e", TS),
        ("USA", "f", 5, None, "restaurant", "g", TS), ("USA", "f", 5, None, "restaurant", "g", TS), ("USA", "f", 6, TS, None, "h", TS)])
    df.write.parquet(f"{tmp_dir}/t")
    staged = spark.read.parquet(f"{tmp_dir}/t")
    for rows in (staged, staged.filter("file_row_number <> 1"), staged.limit(0)):
        want = sorted(map(str, quality.split(rows, quality.OUTLET_RULES)[0].collect()))
        assert sorted(map(str, quality.settled(rows, quality.OUTLET_RULES).collect())) == want
    earlier = spark.createDataFrame([("USA", "f", 4), (None, "f", 6)], "market string, source_file string, file_row_number long")
    bad = quality.rejected(staged, quality.OUTLET_RULES).select(*quality.KEYS).unionByName(earlier)
    assert sorted(map(str, quality.settled(staged, quality.OUTLET_RULES, earlier=earlier).collect())) == sorted(map(str, quality.valid(staged, bad).collect()))
    plan = quality.settled(staged.filter("file_row_number <> 1"), quality.OUTLET_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    plan = quality.settled(staged, quality.OUTLET_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("few", [True, False])
def test_settled_by_written_keys_equals_valid(spark, few):
    staged = _outlets(spark, [
        ("USA", "f", 1, TS, "restaurant", "a", TS), ("USA", "f", 1, None, "restaurant", "b", TS),  # one key, good and bad
        ("USA", "f", 2, TS, "restaurant", "c", TS), ("USA", None, 3, TS, "restaurant", "d", TS), ("USA", None, 3, None, "restaurant", "e", TS),
        ("USA", "f", 4, TS, "restaurant", "g", TS), ("USA", "f", 4, TS, "restaurant", "g", TS), ("USA", "f", 5, None, "restaurant", "h", TS)])
    earlier = spark.createDataFrame([("USA", "f", 4), ("USA", None, 3)], "market string, source_file string, file_row_number long")
    now = quality.rejected(staged, quality.OUTLET_RULES).select(*quality.KEYS)
    kept = quality.settled(staged, quality.OUTLET_RULES, "outlet", earlier, now, few)
    assert sorted(r.raw_record for r in kept.collect()) == ["c", "d", "e"]
    assert sorted(map(str, kept.collect())) == sorted(map(str, quality.valid(staged, now.unionByName(earlier)).collect()))
