import os

from stratum.streaming import file_ingest
from stratum.sources import ingest, layers
from stratum.sources.schemas import MATCHING_FIELDS

HEADER = "\t".join(MATCHING_FIELDS)


def _file(root, rel, ids):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(HEADER + "\n" + "".join(f"{i}\t\"p\nq\"\n" for i in ids))


def test_each_file_loaded_once(spark, tmp_dir):
    root, out = f"{tmp_dir}/land", f"{tmp_dir}/bronze"
    ckpt = f"{tmp_dir}/ckpt"
    _file(root, "MATCHING/USA/a.tsv", [1, 2])
    file_ingest.stream_bronze(spark, root, "matching", out, ckpt, load_ts="2024-01-01 00:00:00").awaitTermination()
    first = file_ingest.read_bronze(spark, out, "parsed")
    assert sorted((r.id_outlet, r.file_row_number) for r in first.collect()) == [("1", 1), ("2", 3)]
    # second run: nothing new
    file_ingest.stream_bronze(spark, root, "matching", out, ckpt, load_ts="2024-01-01 00:00:00").awaitTermination()
    assert file_ingest.read_bronze(spark, out, "parsed").count() == 2
    # a new file alone is picked up by the third run
    _file(root, "MATCHING/GBR/b.tsv", [3])
    file_ingest.stream_bronze(spark, root, "matching", out, ckpt, load_ts="2024-01-01 00:00:00").awaitTermination()
    rows = file_ingest.read_bronze(spark, out, "parsed").collect()
    assert sorted(r.id_outlet for r in rows) == ["1", "2", "3"]
    assert {r.market for r in rows} == {"USA", "GBR"}
    assert file_ingest.read_bronze(spark, out, "raw").count() == 6  # raw rows are physical lines


def test_half_written_batches_are_not_read(spark, tmp_dir):
    root, out = f"{tmp_dir}/land", f"{tmp_dir}/bronze"
    _file(root, "MATCHING/USA/a.tsv", [1])
    file_ingest.stream_bronze(spark, root, "matching", out, f"{tmp_dir}/ckpt", load_ts="2024-01-01 00:00:00").awaitTermination()
    done = spark.read.parquet(f"{out}/parsed/batch=0")
    done.write.parquet(f"{out}/parsed/batch=1")  # as if a batch were being written
    assert file_ingest.read_bronze(spark, out, "parsed").count() == 1
    assert "_corrupt" not in file_ingest.read_bronze(spark, out, "parsed").columns


def test_files_of_one_split_take_three_steps(spark, tmp_dir, monkeypatch):
    """A micro-batch's cost is its number of jobs: where no file is cut, the
    lines, their splits and the records are written, and nothing between."""
    steps, write = [], layers.materialize
    monkeypatch.setattr(layers, "materialize", lambda df, name: steps.append(name) or write(df, name))
    root, body = f"{tmp_dir}/land", 'a\t"p\nq"\nb\tplain\nc\t"x\n\ny"\tz\n'
    for rel, text in (("a.tsv", body), ("b.tsv", body + 'd\t"open\ne\n'), ("c.tsv", "f\tplain\n")):
        os.makedirs(f"{root}/MATCHING/USA", exist_ok=True)
        with open(f"{root}/MATCHING/USA/{rel}", "w") as fh:
            fh.write(HEADER + "\n" + text)
    out = f"{tmp_dir}/bronze"
    file_ingest.stream_bronze(spark, root, "matching", out, f"{tmp_dir}/ckpt", load_ts="2024-01-01 00:00:00").awaitTermination()
    assert len(steps) <= 3
    rows = sorted((r.source_file[-5:], r.file_row_number, r.id_outlet) for r in file_ingest.read_bronze(spark, out, "parsed").collect())
    assert rows == [("a.tsv", 1, "a"), ("a.tsv", 3, "b"), ("a.tsv", 4, "c"), ("b.tsv", 1, "a"), ("b.tsv", 3, "b"), ("b.tsv", 4, "c"), ("b.tsv", 7, "d"),
                    ("b.tsv", 8, "e"), ("c.tsv", 1, "f")]
    assert [r.source_file[-5:] for r in file_ingest.read_bronze(spark, out, "file_issues").collect()] == ["b.tsv"]
    assert file_ingest.read_bronze(spark, out, "raw").count() == 15
    # the same records where the files are cut
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        cut = ingest.ingest(spark, root, "matching", "2024-01-01 00:00:00").parsed.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.source_file[-5:], r.file_row_number, r.id_outlet) for r in cut) == rows
