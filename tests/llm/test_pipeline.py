import importlib
import os

import corpus_pipeline
from stratum.llm import decontam, mixing, ngram_join, queries, shards, toxicity


def test_stages_take_effect_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf_dir)
        at[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == columns
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    before, after = at["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(after) == ids(toxicity.score(before, model).filter("predicted = 0"))
    before, after = at["ngram_jaccard_join"]
    assert ids(after) == ids(ngram_join.near_duplicates(before).filter("doc_id = component_id"))
    before, after = at["decontamination"]
    leaks = set(ids(decontam.contaminated(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))))
    assert ids(after) == [i for i in ids(before) if i not in leaks]
    before, after = at["mixing"]
    assert ids(after) == sorted(i for r in mixing.mix(before).collect() for i in [r["doc_id"]] * r["copies"])
    before, after = at["sharding"]
    assert sorted(map(tuple, after.select("doc_id", "shard").collect())) == sorted(map(tuple, shards.shard(before).select("doc_id", "shard").collect()))


def test_run_and_registration(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and "shard" in out.columns
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLE) <= set(names)


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(importlib.import_module("stratum").__file__))
    for folder, _, files in os.walk(os.path.join(root, "stratum")):
        for f in files:
            if f.endswith(".py") and not folder.endswith("llm"):
                assert "llm" not in open(os.path.join(folder, f)).read()


def test_every_query_returns_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op2_secret_tokens", "op3_jaccard_join", "op4_mix_weights", "op8_toxicity_pu", "op9_jump_shards", "op10_license_dice"):
        assert queries.QUERIES[name](spark, sf_dir).count() == docs
