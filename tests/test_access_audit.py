import re

from stratum.operators import access, audit, checks
from stratum.sources import constants


def _facts(spark):
    return spark.createDataFrame([(m, i) for m in ("USA", "GBR", "DEU") for i in range(3)], "market string, i int")


def test_row_policy(spark):
    ents = constants.entitlements(constants.reference_scope(spark))
    df = _facts(spark)
    seen = lambda role: sorted({r.market for r in access.restrict(df, ents, role).collect()})
    assert seen("MARKET_USA_ANALYST") == ["USA"]
    assert seen("MARKET_HQ_ANALYST") == ["DEU", "GBR", "USA"]
    assert seen("ACCOUNTADMIN") == ["DEU", "GBR", "USA"]
    assert seen("NOBODY") == []
    union = set()
    for m in ("USA", "GBR", "DEU"):
        union |= {tuple(r) for r in access.restrict(df, ents, f"MARKET_{m}_ANALYST").collect()}
    assert union == {tuple(r) for r in access.restrict(df, ents, "MARKET_HQ_ANALYST").collect()}


def test_visible_markets_and_counts(spark):
    ents = constants.entitlements(constants.reference_scope(spark))
    vis = {r.role_name: r.visible_markets for r in access.visible_markets(
        _facts(spark), ents, ["MARKET_GBR_ANALYST", "MARKET_HQ_ANALYST", "SYSADMIN", "NOBODY"]).collect()}
    assert vis == {"MARKET_GBR_ANALYST": ["GBR"], "MARKET_HQ_ANALYST": ["DEU", "GBR", "USA"],
                   "SYSADMIN": ["DEU", "GBR", "USA"], "NOBODY": []}
    counts = [tuple(r) for r in access.role_listing_counts(_facts(spark), ents, "MARKET_USA_ANALYST").collect()]
    assert counts == [("USA", 3)]


def test_coverage_audit_missing_and_extra_market(spark):
    def src(markets):
        return spark.createDataFrame([(m, f"f{i % 2}") for i, m in enumerate(markets)], "market string, source_file string")
    bronze = {"outlet": src([" usa", "GBR", "DEU", "DEU"]), "portfolio": src(["USA", "GBR", "DEU", "FRA"]),
              "matching": src(["USA", "GBR"])}
    expected = constants.expected_coverage(constants.reference_scope(spark))
    rows = {(r.source_name, r.market): r for r in audit.coverage_audit(bronze, expected).collect()}
    assert len(rows) == 9  # the extra FRA market is invisible to the audit
    assert rows[("matching", "DEU")].coverage_status == "missing_expected_market"
    assert rows[("matching", "DEU")].row_count == 0
    assert rows[("outlet", "DEU")].row_count == 2 and rows[("outlet", "DEU")].source_file_count == 2
    assert rows[("outlet", "USA")].coverage_status == "present"
    missing = [tuple(r) for r in audit.missing_coverage(bronze, expected).collect()]
    assert missing == [("matching", "DEU")]
    # ...but accepted_values catches it
    res = checks.run_checks([checks.accepted_values("p", "market", ("USA", "GBR", "DEU"))],
                            {"p": bronze["portfolio"]}).collect()[0]
    assert res.failures == 1 and res.status == "fail"


def test_warn_severity(spark):
    empty = spark.createDataFrame([], "x string")
    full = spark.createDataFrame([("a",)], "x string")
    res = {r.model: r.status for r in checks.run_checks(
        [checks.custom("w1", "empty"), checks.custom("w2", "full")], {"empty": empty, "full": full}).collect()}
    assert res == {"empty": "pass", "full": "warn"}


def test_row_policy_prunes_market_partitions(spark, tmp_dir):
    from stratum.sources import layers
    df = spark.createDataFrame([(m, i) for m in ("USA", "GBR", "DEU") for i in range(10)], "market string, v int")
    back = layers.write_layer(df, tmp_dir, "gold", "t")
    ents = constants.entitlements(constants.reference_scope(spark))
    r = access.restrict(back, ents, "MARKET_GBR_ANALYST")
    plan = r._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: \[.*dynamicpruningexpression\(.*market", plan)  # only entitled partitions are read
    assert [tuple(x) for x in r.groupBy("market").count().collect()] == [("GBR", 10)]


def test_the_active_role_changes_what_a_view_shows(spark):
    from stratum.operators import access

    table = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "market string, v int")
    ents = spark.createDataFrame([("a_role", "A"), ("both", "A"), ("both", "B")], "role_name string, market string")
    (view,) = access.policy_views({"t": table}, ents, admins=("boss",))
    def seen(role):
        spark.sql(f"SET VAR {access.ROLE_VARIABLE} = {'NULL' if role is None else repr(role)}")
        return sorted(r.v for r in spark.table(view).collect())
    assert [seen(r) for r in ("a_role", "both", "boss", "nobody", None)] == [[1], [1, 2], [1, 2, 3], [], []]
    assert sorted(r.market for r in spark.sql("select * from role_markets('both')").collect()) == ["A", "B"]
