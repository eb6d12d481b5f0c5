"""Stand-ins written as tables give the rows of their one SQL text."""
from helpers import SF_SMOKE

from stratum.plans import queries
from stratum.sources import standins


def _rows(df):
    return sorted(map(str, df.collect()))


def test_raw_text_of_a_written_standin_is_that_of_its_scan(spark):
    for s in standins.SOURCES:
        written = queries._bronze(spark, SF_SMOKE, (s,), materialized=(s,))[s]
        scanned = standins.parsed_standin(spark, SF_SMOKE, s, True)
        assert written.columns == scanned.columns and _rows(written) == _rows(scanned)


def test_lines_are_moved_once_by_order_and_once_by_part(spark):
    text = standins.parsed_sql("portfolio", "spark")
    used = {t: spark.read.parquet(f"{SF_SMOKE}/{t}.parquet") for t in standins.DRIVER_TABLES if "{" + t + "}" in text}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = spark.sql(text, **used)
        plan = moved._jdf.queryExecution().executedPlan().toString()
        # of the exchanges only those by order and by part have a line's quantity
        assert sum("Exchange hashpartitioning(l_" in ln for ln in plan.splitlines()) == 2
        assert not any("Exchange hashpartitioning(c_nationkey" in ln and "l_quantity" in ln for ln in plan.splitlines())
        whole = "select " + text.split("select ", 1)[1].split("\nfrom")[0] + "\n" + standins._FROM["portfolio"]
        assert _rows(moved) == _rows(spark.sql(whole, **used))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
