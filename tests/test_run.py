"""End-to-end layered run over files landed from the smoke tables."""
from pyspark.sql import functions as F

from helpers import SF_SMOKE

from stratum.plans import run
from stratum.sources import landing, standins
from stratum.sources.schemas import SOURCE_FIELDS


def _land(spark, root, source):
    df = standins.parsed_standin(spark, SF_SMOKE, source)
    line = F.concat_ws("\t", *[F.expr(landing.encode_sql(f)) for f in SOURCE_FIELDS[source]])
    rows = df.select(F.upper(F.trim("market")).alias("market"), F.lit(0).alias("bucket"),
                     F.col("file_row_number").alias("seq"), line.alias("line"))
    landing.write_landing(rows, root, source)


def test_layered_run_from_files(spark, tmp_dir):
    root, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    for s in ("outlet", "portfolio", "matching"):
        _land(spark, root, s)
    res = run.run(spark, root, wh, "2024-06-01 00:00:00",
                  scope=standins.DriverTables(spark, SF_SMOKE)["region"].selectExpr(
                      "upper(r_name) as market", "r_name as market_name"),
                  accepted_markets=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
    fact = res.layers.gold["fct_outlet_product_listing"]
    assert fact.count() > 0
    assert res.layers.staged["outlet"].filter("raw_record is null").count() == 0  # raw text carried along
    status = {r.check_name: r.status for r in res.checks.collect()}
    assert status["accepted_values__stg_outlets__market"] == "pass"
    assert status["unique__dim_market__market_key"] == "pass"
    assert {r.coverage_status for r in res.coverage.collect()} == {"present"}
    assert res.file_issues.count() == 0
    assert spark.read.parquet(f"{wh}/BRONZE/OUTLET_RAW").count() == res.bronze["outlet"].count()  # no enclosed newlines here
    assert spark.read.parquet(f"{wh}/SECURITY/role_market_entitlements").count() == 10
    assert res.labels.count() == res.layers.valid["portfolio"].filter("coalesce(item_name, addon_text) is not null").count()
    again = run.score_new_listings(res.layers.valid["portfolio"], wh, "2024-06-09 00:00:00")
    assert again.count() == res.labels.count()  # nothing new, nothing scored twice
    assert spark.table("gold__fct_outlet_product_listing").count() == fact.count()


def test_each_file_is_loaded_once_and_replays_agree(spark, tmp_dir):
    import os

    root, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"

    def put(name, ids):
        os.makedirs(f"{root}/MATCHING/USA", exist_ok=True)
        with open(f"{root}/MATCHING/USA/{name}", "w") as fh:
            fh.write("\t".join(SOURCE_FIELDS["matching"]) + "\n" + "".join(f"{i}\n" for i in ids))

    def load():
        parsed, _ = run.load_bronze(spark, root, wh, "2024-06-01 00:00:00", sources=("matching",))
        return sorted(r.id_outlet for r in parsed["matching"].collect())

    put("a.tsv", [1, 2])
    assert load() == ["1", "2"]
    assert load() == ["1", "2"]
    put("b b.tsv", [3])
    assert load() == ["1", "2", "3"]
    put("c.tsv", [4])
    assert load() == ["1", "2", "3", "4"]
    for mark in ("3.lock", "3-load=3"):  # as if the load had failed before its commit
        os.remove(f"{wh}/AUDIT/MATCHING_FILES/commits/{mark}")
    assert load() == ["1", "2", "3", "4"]
    # another load has claimed a number and not committed: the next takes its own
    assert run._claim(spark, f"{wh}/AUDIT/MATCHING_FILES/load=5.claim")
    put("d.tsv", [5])
    assert load() == ["1", "2", "3", "4", "5"]
    assert os.path.isdir(f"{wh}/BRONZE/MATCHING_PARSED/load=6/market=USA")


def test_a_load_whose_files_another_has_committed_is_given_up(spark, tmp_dir, monkeypatch):
    import os

    import pytest

    root, wh = f"{tmp_dir}/landing", f"{tmp_dir}/warehouse"
    os.makedirs(f"{root}/MATCHING/USA")
    with open(f"{root}/MATCHING/USA/a.tsv", "w") as fh:
        fh.write("\t".join(SOURCE_FIELDS["matching"]) + "\n1\n")
    inner = run._next_number

    def meanwhile(spark, folder):
        number = inner(spark, folder)
        monkeypatch.setattr(run, "_next_number", inner)
        run.load_bronze(spark, root, wh, "2024-06-01 00:00:00", sources=("matching",))
        return number

    monkeypatch.setattr(run, "_next_number", meanwhile)
    with pytest.raises(RuntimeError, match="given up"):
        run.load_bronze(spark, root, wh, "2024-06-01 00:00:00", sources=("matching",))
    parsed, _ = run.load_bronze(spark, root, wh, "2024-06-01 00:00:00", sources=("matching",))
    assert [r.id_outlet for r in parsed["matching"].collect()] == ["1"]
