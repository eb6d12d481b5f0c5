import datetime as dt

from pyspark.sql import functions as F

from stratum.functions import casts, keys, text


def _one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_safe_double(spark):
    got = _one(spark, ["1.5", " 7 ", "1e3", "NaN", "Infinity", "1.0d", "abc", "", None], casts.safe_double)
    assert got == [1.5, 7.0, 1000.0, None, None, None, None, None, None]


def test_safe_number_rounds_half_away_from_zero(spark):
    assert _one(spark, ["2.5", "-2.5", "7", "x", None], casts.safe_number) == [3, -3, 7, None, None]


def test_safe_timestamp_iso_only(spark):
    got = _one(spark, ["2024-01-02 03:04:05", "2024-01-02", "2024", "01/02/2024", None], casts.safe_timestamp)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), None, None, None]


def test_flags(spark):
    assert _one(spark, ["1", "0", "true", None], casts.flag_one) == [True, False, False, False]
    assert _one(spark, ["TRUE", "true", "1", None], casts.flag_true) == [True, True, False, False]


def test_text_helpers(spark):
    assert _one(spark, [" usa ", "gbr"], text.canon_market) == ["USA", "GBR"]
    assert _one(spark, ["Uber-Eats view!"], text.alnum_lower) == ["ubereatsview"]
    assert _one(spark, ["NULL", "null", "", "x", None], text.null_if_token) == [None, None, None, "x", None]
    assert _one(spark, ["OUTLET/USA/a.tsv", "OUTLET"], text.market_from_path) == ["USA", ""]


def test_surrogate_key_null_safe_and_ordered(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()]
    assert all(g is not None and len(g) == 32 for g in got)
    assert len(set(got)) == 3  # NULL position matters


def test_surrogate_key_matches_sql_twin(spark):
    import duckdb
    spark_key = spark.createDataFrame([("USA", None)], "m string, p string").select(
        keys.surrogate_key("m", "p")).collect()[0][0]
    duck_key = duckdb.sql("select " + keys.surrogate_key_sql("'USA'", "null") + " as k").fetchall()[0][0]
    assert spark_key == duck_key
