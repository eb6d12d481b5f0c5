import os

from pyspark.sql import functions as F

from stratum.sources import drift, ingest
from stratum.sources.schemas import MATCHING_FIELDS as M

TS = "2024-01-01 00:00:00"


def write(root, name, header, *rows):
    path = os.path.join(root, "MATCHING", "USA", name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write("\n".join("\t".join(r) for r in [header, *rows]) + "\n")


def load(spark, root):
    parsed, table = drift.parse_by_header(ingest.land(spark, root, "matching", cut_lineage=True), "matching", TS)
    rows = {(os.path.basename(r.source_file), r.file_row_number): r for r in parsed.collect()}
    found = {(os.path.basename(r.source_file), r.kind, r.field, r.position, r.found_name, r.found_position) for r in table.collect()}
    return rows, found


def values(fields, tag="v"):
    return [f"{tag} {f}" for f in fields]


def test_moved_added_and_missing_columns(spark, tmp_dir):
    moved = (*M[1:], M[0])
    added = (*M[:5], "note", *M[5:])
    missing = tuple(f for f in M if f not in ("sd", "place_id"))
    write(tmp_dir, "plain.tsv", M, values(M), ["1", "short"])
    write(tmp_dir, "moved.tsv", moved, values(moved), values(moved)[:-1] + ['"a\tb\nc"'])
    write(tmp_dir, "added.tsv", added, values(added), values(added)[:-1], values(added) + ["long"])
    write(tmp_dir, "missing.tsv", missing, values(missing), ["NULL"] * len(missing))
    rows, found = load(spark, tmp_dir)
    for name in ("plain", "moved", "added"):
        assert [rows[f"{name}.tsv", 1][f] for f in M] == values(M) and rows[f"{name}.tsv", 1]["_corrupt"] is None
    assert rows["moved.tsv", 2].id_outlet == "a\tb\nc" and rows["moved.tsv", 2].id_platform == "v id_platform"
    assert rows["plain.tsv", 2]["_corrupt"] and rows["added.tsv", 2]["_corrupt"] and rows["added.tsv", 3]["_corrupt"]
    assert rows["added.tsv", 2].created_at is None and rows["added.tsv", 3].created_at == "v created_at"
    assert [rows["missing.tsv", 1][f] for f in M] == [None if f in ("sd", "place_id") else f"v {f}" for f in M]
    assert not any(rows["missing.tsv", 2][f] for f in M) and rows["missing.tsv", 2]["_corrupt"] is None
    assert {x for x in found if x[0] == "missing.tsv" and x[1] == "missing"} == {("missing.tsv", "missing", f, M.index(f), None, None) for f in ("sd", "place_id")}
    assert {x for x in found if x[0] == "added.tsv" and x[1] != "moved"} == {("added.tsv", "added", None, None, "note", 5)}
    assert {x[2] for x in found if x[0] == "moved.tsv"} == set(M) and not any(x[0] == "plain.tsv" for x in found)


def test_names(spark, tmp_dir):
    spelt = tuple({"id_outlet": '"Id Outlet"', "place_id": "PLACE-ID", "merged_chain_name": "merged_chain_nam", "created_at": "when"}.get(f, f) for f in M)
    twice = (*M, "sd")
    close = tuple({"similarity_score_name": "similarity_scor_name", "similarity_score_address": "similarity_scor_name"}.get(f, f) for f in M)
    other = tuple(f"c{i}" for i in range(len(M)))
    for name, header in (("spelt", spelt), ("twice", twice), ("close", close), ("other", other)):
        write(tmp_dir, f"{name}.tsv", header, [str(i) for i in range(len(header))])
    rows, found = load(spark, tmp_dir)
    at = M.index
    assert rows["spelt.tsv", 1].id_outlet == "0" and rows["spelt.tsv", 1].place_id == str(at("place_id"))
    assert rows["spelt.tsv", 1].merged_chain_name == str(at("merged_chain_name")) and rows["spelt.tsv", 1].created_at is None
    assert {x[1:3] for x in found if x[0] == "spelt.tsv"} == {("renamed", "merged_chain_name"), ("missing", "created_at"), ("added", None)}
    assert rows["twice.tsv", 1].sd == str(at("sd")) and [x[1] for x in found if x[0] == "twice.tsv"] == ["added"]
    # two columns equally near a field: neither is taken for it
    assert rows["close.tsv", 1].similarity_score_name is None and rows["close.tsv", 1].similarity_score_address is None
    # a header that says nothing: bound by position
    assert [rows["other.tsv", 1][f] for f in M] == [str(i) for i in range(len(M))]
    assert {x[1] for x in found if x[0] == "other.tsv"} == {"unrecognised"}


def test_no_drift_and_no_rows(spark, tmp_dir):
    write(tmp_dir, "plain.tsv", M)
    rows, found = load(spark, tmp_dir)
    assert not rows and not found
    landed = ingest.land(spark, tmp_dir, "matching", cut_lineage=True)
    landed.records = landed.records.filter(F.lit(False))
    parsed, table = drift.parse_by_header(landed, "matching", TS)
    assert parsed.count() == table.count() == 0


def test_equals_the_positional_load_without_drift(spark, tmp_dir):
    write(tmp_dir, "a.tsv", M, values(M), values(M, '"q"'), ["x"])
    landed = ingest.land(spark, tmp_dir, "matching", cut_lineage=True)
    ours, theirs = drift.parse_by_header(landed, "matching", TS)[0], ingest.to_parsed(landed, "matching", TS, keep_corrupt=True)
    assert ours.columns == theirs.columns and sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))
