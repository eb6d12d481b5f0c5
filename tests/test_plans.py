"""Plan-shape properties that matter at scale."""

import os
import re

from pyspark.sql import functions as F
import tempfile

from helpers import bronze

from stratum.operators import conform, quality
from stratum.sources import ingest
from stratum.sources.schemas import MATCHING_FIELDS


def _plan(spark, df):
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _count(plan, op):
    return len(re.findall(r"^\(\d+\) " + op, plan, flags=re.M))


def test_ingest_reads_text_once_after_lineage_cuts(spark, tmp_dir):
    header = "\t".join(MATCHING_FIELDS)
    os.makedirs(f"{tmp_dir}/MATCHING/USA")
    with open(f"{tmp_dir}/MATCHING/USA/multi.tsv", "w") as fh:
        fh.write(header + "\n1\t\"a\nb\"\n2\tx\n")
    with open(f"{tmp_dir}/MATCHING/USA/simple.tsv", "w") as fh:
        fh.write(header + "\n3\ty\n")
    recs = ingest.land(spark, tmp_dir, "matching", cut_lineage=True).records
    plan = _plan(spark, recs)
    assert _count(plan, "Scan text") == 0  # its lines were written by one scan
    assert _count(plan, "Window") <= 1
    assert sorted((r.file_row_number, r.record) for r in recs.collect() if r.file_row_number > 0) == [
        (1, '1\t"a\nb"'), (1, "3\ty"), (3, "2\tx")]


def _landed(root, files=6):
    header = "\t".join(MATCHING_FIELDS)
    os.makedirs(f"{root}/MATCHING/USA")
    for i in range(files):
        with open(f"{root}/MATCHING/USA/f{i}.tsv", "w") as fh:
            fh.write(header + "\n" + "".join(f"{i}-{j}\tx\n" for j in range(5)))


def test_raw_lines_are_numbered_without_moving_the_text(spark, tmp_dir, monkeypatch):
    _landed(tmp_dir)
    whole = ingest.ingest(spark, tmp_dir, "matching", "2024-01-01 00:00:00")
    monkeypatch.setattr(ingest, "BROADCAST_BYTES", 400)  # the split table goes out in pieces
    pieces = ingest.ingest(spark, tmp_dir, "matching", "2024-01-01 00:00:00")
    for load, broadcasts in ((whole, 1), (pieces, 2)):
        plan = _plan(spark, load.raw)
        assert _count(plan, "BroadcastExchange") >= broadcasts and _count(plan, "Exchange") == 0 and _count(plan, "SortMergeJoin") == 0
        assert sorted((r.source_file, r.file_row_number, r.raw_data) for r in load.raw.collect()) == [
            (f"MATCHING/USA/f{i}.tsv", j + 1, f"{i}-{j}\tx") for i in range(6) for j in range(5)]
    assert _count(_plan(spark, pieces.raw), "BroadcastExchange") > 1


def test_valid_split_reads_two_pruned_scans(spark, tmp_dir):
    bronze(spark, "portfolio", [{"item_price": "1"}, {"item_price": None}]).write.parquet(f"{tmp_dir}/bronze")
    staged = conform.stg_portfolio(spark.read.parquet(f"{tmp_dir}/bronze"))
    valid = quality.split(staged, quality.PORTFOLIO_RULES)[0].select("market", "item_name")
    plan = _plan(spark, valid)
    assert "LeftAnti" in plan and "Union" not in plan
    reads = re.findall(r"ReadSchema: struct<(.*)>", plan)
    keys = {"market:string", "source_file:string", "file_row_number:bigint"}
    assert sorted(set(r.split(",")) - keys for r in reads) == sorted([{"item_name:string"}, {"item_price:string"}])


def test_null_keys_of_the_valid_split_are_spread(spark, tmp_dir):
    """Rows with NULL keys meet in one partition of the join; AQE splits it."""
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("m"), F.col("id") % 50)).alias("market"), F.when(F.col("id") % 100 == 2, "f").alias("source_file"),
        F.when(F.col("id") % 100 == 2, F.col("id")).alias("file_row_number"), F.when(F.col("id") % 3 > 0, 1.0).alias("item_price"), F.sha2(F.col("id").cast("string"), 512).alias("raw_record"),
        F.lit(None).cast("timestamp_ntz").alias("load_timestamp"))
    rows.write.parquet(f"{tmp_dir}/staged")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        valid = quality.split(spark.read.parquet(f"{tmp_dir}/staged"), quality.PORTFOLIO_RULES)[0]
        assert len(valid.collect()) == 400_000 - sum(i % 100 == 2 and i % 3 == 0 for i in range(400_000))  # only whole keys remove rows
        assert "skewed=true" in valid._jdf.queryExecution().executedPlan().toString() or "skew=true" in valid._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)



def test_counting_reads_few_columns(spark):
    """The valid / rejected join asks for the keys and what its consumer reads."""
    path = os.path.join(tempfile.mkdtemp(prefix="stratum-test-"), "p")
    conform.stg_portfolio(bronze(spark, "portfolio", [{"item_price": "1"}, {"item_price": None}])).write.parquet(path)
    valid = quality.split(spark.read.parquet(path), quality.PORTFOLIO_RULES)[0]
    read = [ln for ln in _plan(spark, valid.groupBy("market").count()).splitlines() if "ReadSchema" in ln]
    assert read and all(ln.count(":") - 1 <= 4 for ln in read), read

def test_dedup_is_planned_as_group_limit(spark):
    from stratum.operators import dims
    staged = conform.stg_portfolio(bronze(spark, "portfolio", [{"item_price": "1", "id_beverage": "b"}]))
    plan = _plan(spark, dims.dim_product(quality.split(staged, quality.PORTFOLIO_RULES)[0]))
    assert "WindowGroupLimit" in plan


def test_joins_of_bucketed_tables_exchange_nothing(spark):
    from stratum.operators import dims, facts
    from stratum.sources import layers

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = [{"item_price": p, "id_outlet": "o", "id_beverage": "b", "id_ext_link": "a", "created_at": "2024-01-01"} for p in ("1", None, "2")]
        staged = layers.write_bucketed(conform.stg_portfolio(bronze(spark, "portfolio", items)), "stg", quality.KEYS, 4)
        valid = quality.split(staged, quality.PORTFOLIO_RULES)[0]
        plan = _plan(spark, valid)
        assert "SortMergeJoin LeftAnti" in plan and _count(plan, "Exchange") == 0
        outlets = conform.stg_outlets(bronze(spark, "outlet", [{"id_outlet": "o", "id_ext_link": "a", "segment_type": "restaurant", "created_at": "2024-01-01"}]))
        dim = dims.dim_outlet(outlets, conform.stg_matching(bronze(spark, "matching", [{"id_outlet": "o"}])))
        link = ["market", "id_ext_link"]
        fact = facts.fct_listing(layers.write_bucketed(valid, "valid", link, 4), layers.write_bucketed(dim, "dim", link, 4))
        plan = _plan(spark, fact)
        assert "SortMergeJoin" in plan and _count(plan, "Exchange") == 0
        assert fact.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_grow_with_the_table():
    from stratum.sources import layers
    assert [layers.buckets(n, 16) for n in (0, 600_000, 8_000_001, 216_000_000)] == [16, 16, 17, 432]


def test_listings_dealt_for_the_fact_are_what_it_reads(spark):
    from stratum.operators import dims, facts
    ok = {"item_price": "1", "id_outlet": "o", "id_beverage": "b", "id_ext_link": "a", "created_at": "2024-01-01", "item_desc": "long text"}
    staged = conform.stg_portfolio(bronze(spark, "portfolio", [ok, ok | {"id_ext_link": None}, ok | {"id_outlet": None}, ok | {"id_beverage": None}, ok | {"market": None}, ok]))
    outlets = conform.stg_outlets(bronze(spark, "outlet", [{"id_outlet": "o", "id_ext_link": "a", "segment_type": "restaurant", "created_at": "2024-01-01"}]))
    dim = dims.dim_outlet(outlets, conform.stg_matching(bronze(spark, "matching", [{"id_outlet": "o"}])))
    dealt = facts.linked_listings(staged)
    assert dealt.columns == facts.LISTING_COLUMNS and dealt.count() == 2
    assert sorted(facts.fct_listing(dealt, dim).collect()) == sorted(facts.fct_listing(staged, dim).collect())


def test_fact_bucketed_writes_narrow_tables(spark, monkeypatch):
    from stratum.operators import dims, facts
    from stratum.plans import queries
    from stratum.sources import layers, standins
    one = {"outlet": {"segment_type": "restaurant"}, "portfolio": {"item_price": "1", "id_beverage": "b"}, "matching": {}}
    rows = {s: bronze(spark, s, [r | {"id_outlet": "o", "id_ext_link": "a", "created_at": "2024-01-01"}]) for s, r in one.items()}
    monkeypatch.setattr(queries, "_bronze", lambda *_, **__: rows)
    monkeypatch.setattr(standins, "read_table", lambda *_: spark.range(3))
    wrote, write = {}, layers.write_bucketed
    monkeypatch.setattr(layers, "write_bucketed", lambda df, name, keys, n: wrote.update({name: (set(df.columns), n)}) or write(df, name, keys, n))
    assert queries.QUERIES["fact_bucketed"](spark, "unused").count() == 1
    listing = set(facts.LISTING_COLUMNS)
    assert wrote["stg_portfolio"] == (listing | {"raw_record"}, queries.BUCKETS) and wrote["linked_listings"] == (listing, queries.BUCKETS)
    assert wrote["stg_matching"][0] == {*quality.KEYS, *dims.SIGNAL_COLUMNS, "created_at", "load_timestamp", "raw_record"}
