import os
import random

import pytest
from pyspark.sql import functions as F

from stratum.sources import ingest
from stratum.sources.schemas import MATCHING_FIELDS

HEADER = "\t".join(MATCHING_FIELDS)


def _write(root, rel, text, encoding="utf-8"):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def _row(*fields):
    vals = list(fields) + [""] * (len(MATCHING_FIELDS) - len(fields))
    return "\t".join(vals)


def test_edge_rows(spark, tmp_dir):
    body = "\n".join([
        HEADER,
        _row("1", '"a\tb"', "p"),                    # tab inside quotes
        _row("2", '"line1\nline2"', "p"),             # newline inside quotes (2 physical lines)
        _row("3", '"say ""hi"""', "p"),               # doubled quote
        _row("4", "NULL", "null", "", "  padded  "),  # NULL tokens and padding
        "5\tshort",                                   # short row
        _row("6") + "\textra",                        # long row
    ]) + "\n"
    _write(tmp_dir, "MATCHING/usa/f1.tsv", "﻿" + body)
    _write(tmp_dir, "MATCHING/GBR/empty.tsv", HEADER + "\n")
    _write(tmp_dir, "MATCHING/usa/f2.tsv", HEADER + "\n" + _row("7", 'x"y') + "\n")
    _write(tmp_dir, "MATCHING/DEU/bad.tsv", HEADER + "\n" + _row("8", "z") + "\n" + _row("9", '"never') + "\n" + _row("10", "w") + "\n")
    load = ingest.ingest(spark, tmp_dir, "matching", "2024-01-01 00:00:00", staged_records=False, raw_mode="record")
    parsed = {r.id_outlet: r for r in load.parsed.collect()}
    assert set(parsed) == {"1", "2", "3", "4", "5", "6", "7", "8", "9", "10"}  # no quote loses a row
    assert parsed["7"].id_platform == 'x"y' and parsed["10"].id_platform == "w"
    assert parsed["1"].id_platform == "a\tb"
    assert parsed["2"].id_platform == "line1\nline2"
    assert parsed["3"].id_platform == 'say "hi"'
    assert parsed["4"].id_platform is None and parsed["4"].platform_name is None
    assert parsed["4"].id_ext_link is None and parsed["4"].place_id == "padded"
    assert parsed["5"].id_platform == "short" and parsed["5"].platform_name is None
    assert parsed["6"].created_at is None
    # record numbers: header is line 0, the quoted newline takes lines 2-3
    assert [parsed[k].file_row_number for k in "123456"] == [1, 2, 4, 5, 6, 7]
    assert {r.market for r in load.parsed.collect()} == {"usa", "DEU"}
    assert parsed["1"].source_file == "MATCHING/usa/f1.tsv"
    raw = {r.file_row_number: r.raw_data for r in load.raw.collect() if r.source_file == "MATCHING/usa/f1.tsv"}
    assert raw[2] == _row("2", '"line1\nline2"', "p")
    assert sorted(raw) == [1, 2, 4, 5, 6, 7]
    issues = [tuple(r) for r in load.file_issues.collect()]
    assert issues == [("MATCHING/DEU/bad.tsv", "UNBALANCED_QUOTES")]
    assert sorted(r.file_row_number for r in load.parse_issues.collect() if "f1" in r.source_file) == [6, 7]
    lines = ingest.ingest(spark, tmp_dir, "matching", "2024-01-01 00:00:00", staged_records=False).raw
    by_line = {(r.source_file, r.file_row_number): r.raw_data for r in lines.collect()}
    assert by_line[("MATCHING/usa/f1.tsv", 2)] == '2\t"line1'  # the raw line format splits quoted newlines
    assert by_line[("MATCHING/usa/f1.tsv", 3)] == 'line2"\tp' + "\t" * (len(MATCHING_FIELDS) - 3)
    assert ("MATCHING/DEU/bad.tsv", 1) in by_line  # unbalanced quotes are no error for raw lines


def _brute_force(text):
    """Reference record splitter, character by character: a quote opens a field
    only at the field's start (after spaces) and a doubled one inside is data."""
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    out, start, inside = [], 0, False
    for i, line in enumerate(lines):
        if not inside:
            start = i
        at, k = "body" if inside else "start", 0
        while k < len(line):
            c = line[k]
            if at == "body":
                if c == '"' and line[k + 1: k + 2] == '"':
                    k += 1
                elif c == '"':
                    at = "rest"
            elif c == "\t":
                at = "start"
            elif at == "start" and c != " ":
                at = "body" if c == '"' else "rest"
            k += 1
        inside = at == "body"
        if not inside:
            out.append((start, "\n".join(lines[start: i + 1])))
    if inside:  # never ends: its lines stand alone
        out += [(i, lines[i]) for i in range(start, len(lines))]
    return [(n, r) for n, r in out if n > 0]


@pytest.mark.parametrize("split_bytes", ["1024", "4096"])
def test_many_splits_match_brute_force(spark, tmp_dir, split_bytes):
    rnd = random.Random(7)
    expected = {}
    for f in range(3):
        rows = [HEADER]
        for i in range(400):
            v = rnd.choice(["plain", '"q\tq"', '"multi\nline\nvalue"', '"a ""b"" c"', "x", 'mid 12" x', 'a"b"', ' "sp\naced"', '"" ', '"\n""\n"x'])
            rows.append(_row(str(i), v, "p" * rnd.randint(0, 40)))
        if f == 2:
            rows += [_row("open", '"never ends')] + [_row(str(i), rnd.choice(["p", 'x"y'])) for i in range(50)]
        text = "\n".join(rows) + "\n"
        rel = f"MATCHING/M{f}/part{f}.tsv"
        _write(tmp_dir, rel, text)
        expected[rel] = _brute_force(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = ingest.read_lines(spark, f"{tmp_dir}/MATCHING")
        assert lines.rdd.getNumPartitions() > 3  # files really are split
        recs = ingest.land(spark, tmp_dir, "matching").records
        got = {}
        for r in recs.filter(F.col("file_row_number") > 0).collect():
            got.setdefault(r.source_file, []).append((r.file_row_number, r.record))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for rel, exp in expected.items():
        assert sorted(got[rel]) == exp


def test_invalid_encoding_skips_raw_file_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "MATCHING/USA/latin.tsv")
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as fh:
        fh.write((HEADER + "\n").encode() + _row("1", "caf\xe9").encode("latin-1") + b"\n")
    load = ingest.ingest(spark, tmp_dir, "matching", "2024-01-01 00:00:00", staged_records=False)
    assert load.raw.count() == 0
    assert load.parsed.count() == 1
    assert [r.issue for r in load.file_issues.collect()] == ["INVALID_ENCODING"]


def test_line_numbers_survive_another_split_layout(spark, tmp_dir):
    """All steps derive from one written scan, so a layout that changes between
    them (executors come and go) loses no line."""
    _write(tmp_dir, "MATCHING/USA/big.tsv", HEADER + "\n" + "\n".join(_row(str(i), '"a\nb"' if i % 5 == 0 else "x") for i in range(3000)) + "\n")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "4")
        landed = ingest.land(spark, tmp_dir, "matching", cut_lineage=True)
        spark.conf.set("spark.sql.files.minPartitionNum", "7")
        assert landed.records.count() == 3001
        assert sorted(r[0] for r in landed.lines.select("file_row_number").collect()) == list(range(3601))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
