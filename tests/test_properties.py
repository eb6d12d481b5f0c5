"""Property tests: the Spark expressions and their SQL twins agree on
arbitrary text (the oracle relies on this)."""
import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions import casts, keys

NUMERIC_ALPHABET = "0123456789+-.eE ndaNIfity"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=NUMERIC_ALPHABET, max_size=12)), min_size=1, max_size=40)


def _duck(values, expr):
    con = duckdb.connect()
    con.execute("create table t (i integer, v varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"select {expr} from t order by i").fetchall()]


def _spark(spark, values, col):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


@settings(max_examples=15, deadline=None)
@given(texts)
def test_safe_casts_match_sql_twins(spark, values):
    assert _spark(spark, values, casts.safe_double(F.col("v"))) == _duck(values, casts.safe_double_sql("v"))
    assert _spark(spark, values, casts.safe_number(F.col("v"))) == _duck(values, casts.safe_number_sql("v"))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=8)), min_size=1, max_size=30))
def test_surrogate_key_matches_sql_twin(spark, values):
    assert _spark(spark, values, keys.surrogate_key(F.col("v"), F.lit("x"))) == \
        _duck(values, keys.surrogate_key_sql("v", "'x'"))
