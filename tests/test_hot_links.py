import statistics
from contextlib import contextmanager

from pyspark.sql import functions as F

from stratum.operators import facts

PARTS = 8


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def listings(spark, n=40_000):
    """Three in ten listings hold one link, some none at all."""
    link = F.when(F.col("id") % 10 < 3, F.lit("hot")).when(F.col("id") % 97 != 0, F.concat(F.lit("l"), F.col("id") % 2_000))
    return spark.range(n).select(F.lit("M").alias("market"), link.alias("id_ext_link"), F.col("id").alias("n"))


def outlets(spark):
    links = spark.range(2_000).select(F.concat(F.lit("l"), F.col("id")).alias("id_ext_link"), F.lit("a").alias("outlet"))
    hot = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("hot", "b"), (None, "c")], "id_ext_link string, outlet string")
    return links.unionByName(hot).select(F.lit("M").alias("market"), "*")


def task_rows(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_same_rows_and_even_tasks(spark):
    plain = lambda ls, os: ls.join(os, ["market", "id_ext_link"])
    ls, os = listings(spark), outlets(spark)
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions=str(PARTS)):
        spread, whole = facts.join_spread(ls, os, PARTS), plain(ls, os)
        assert spread.columns == whole.columns
        assert spread.exceptAll(whole).count() == whole.exceptAll(spread).count() == 0
        even, hot = task_rows(spread), task_rows(whole)
    assert max(hot) > 3 * statistics.median(hot)
    assert max(even) < 2 * statistics.median(even)


def test_hot_links_are_those_over_a_share(spark):
    found = {r.id_ext_link: r["_pieces"] for r in facts.hot_links(listings(spark), PARTS).collect()}
    assert set(found) == {"hot"} and abs(found["hot"] - 0.3 * PARTS * facts.PIECES) <= 1


def test_empty_and_null_links(spark):
    ls, os = listings(spark, 100), outlets(spark)
    assert facts.join_spread(ls.limit(0), os, PARTS).count() == 0
    assert facts.join_spread(ls, os.limit(0), PARTS).count() == 0
    assert facts.join_spread(ls.withColumn("id_ext_link", F.lit(None).cast("string")), os, PARTS).count() == 0


def test_links_of_any_text(spark):
    odd = spark.range(60).select(F.lit('a"\\\t').alias("market"), F.lit("l {}").alias("id_ext_link"), "id")
    assert facts.join_spread(odd, odd.select("market", "id_ext_link", F.col("id").alias("o")).limit(2), PARTS).count() == 120
    assert facts.hot_links(odd, PARTS).count() == 1


def test_links_are_counted_once(spark):
    """Both sides are dealt by one written count: sketches of two passes may
    differ, and each pass reads all listings."""
    plan = facts.join_spread(listings(spark), outlets(spark), PARTS)._jdf.queryExecution().toString()
    assert "_pieces" in plan and "approx_top_k" not in plan
    even = listings(spark).filter("id_ext_link <> 'hot'")
    assert "_piece" not in facts.join_spread(even, outlets(spark), PARTS)._jdf.queryExecution().toString()
