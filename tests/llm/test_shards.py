import zlib

from cases import clashing, documents
from pyspark.sql import functions as F

from stratum.llm import shards


def jump(key, n):
    b, j, key = -1, 0, key % 2 ** 64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (2 ** 31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_loop(spark):
    keys = [0, 1, -1, 5, 2 ** 63 - 1, -(2 ** 63), 123456789012345, *range(1000, 1300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 1000, 100_000):
        got = {r["k"]: r["s"] for r in df.select("k", shards.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_contract(spark, monkeypatch):
    monkeypatch.setattr(shards, "ROWS_PER_BUCKET", 40)
    data = [(i, f"text é {i % 17}" * (i % 5)) for i in range(400)] + [(7, "again"), (7, "again"), (None, None), (None, "x")]
    out = shards.shard(clashing(documents(spark, data)).repartition(5)).collect()
    assert len(out) == len(data)
    text = {}
    for i, t in data:
        text.setdefault(i, set()).add(((len((t or "").encode()) + 1), zlib.crc32((t or "").encode())))
    for r in out:
        assert (r["size"], r["text_crc32"]) in text[r["doc_id"]] and r["law"] == "key"
        assert r["shard"] == jump(r["doc_id"] or 0, 8) and r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_empty_table(spark):
    assert shards.shard(documents(spark, [])).count() == 0
