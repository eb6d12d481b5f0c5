import random

import pytest
from helpers import bronze
from pyspark.sql import functions as F

from stratum.operators import alignment
from stratum.sources.layers import materialize
from stratum.sources.schemas import SOURCE_FIELDS


def around(lines, shifts, end):
    """The shifts of the nearest lines before and after each line."""
    out = {}
    for i, line in enumerate(lines):
        before = [shifts[x] for x in lines[:i] if x in shifts]
        after = [shifts[x] for x in lines[i + 1:] if x in shifts]
        out[line] = (before[-1] if before else 0, after[0] if after else end)
    return out


def brute(parsed, raw):
    """The definition, line by line, for one file: (row, text) pairs."""
    parsed, raw = sorted(set(parsed)), sorted(set(raw))
    if not parsed or not raw:
        return {}
    end, pairs = raw[-1][0] - parsed[-1][0], {}
    once = lambda lines: {t: n for n, t in lines if sum(t == u for _, u in lines) == 1}
    ours, theirs = once(parsed), once(raw)
    pairs = {(n, t): (theirs[t], t, "unique") for t, n in ours.items() if t in theirs}

    def nearest():
        shifts = {x: pairs[x][0] - x[0] for x in pairs if pairs[x][2] in ("unique", "extended")}
        near = around(sorted(shifts), shifts, end)
        steady = {x: s for x, s in shifts.items() if not (near[x][0] == near[x][1] != s)}
        return around(parsed, steady, end)

    free = lambda: [x for x in raw if x not in {v[:2] for v in pairs.values()}]
    near, claims, open_raw = nearest(), {}, free()
    for n, t in parsed:
        if (n, t) not in pairs:
            for s in set(near[n, t]):
                if (n + s, t) in open_raw:
                    claims.setdefault((n + s, t), []).append(n)
    won = {}
    for (rn, t), rows in claims.items():
        won.setdefault((min(rows), t), []).append(rn)
    pairs |= {x: (min(rns), x[1], "extended") for x, rns in won.items()}
    near = nearest()
    open_raw = free()
    for t in {t for _, t in parsed}:
        mine = [n for n, u in parsed if u == t and (n, u) not in pairs]
        pairs |= {(n, t): (rn, t, "repeated") for n, rn in zip(mine, [rn for rn, u in open_raw if u == t])}
    open_raw = free()
    seen = set()
    for n, t in parsed:
        if (n, t) not in pairs and near[n, t][0] == near[n, t][1] and n not in seen:
            texts = [u for rn, u in open_raw if rn == n + near[n, t][0]]
            seen.add(n)
            if texts:
                pairs[n, t] = (n + near[n, t][0], min(texts), "position")
    return pairs


def edited(rng, size):
    """A file and a copy of it with lines missing, doubled, changed, moved."""
    texts = [rng.choice("abc") if rng.random() < 0.4 else f"t{i}" for i in range(size)]
    ours = [t for t in texts if rng.random() > 0.06]
    theirs = []
    for t in texts:
        roll = rng.random()
        theirs += [] if roll < 0.05 else [t, t] if roll < 0.1 else [t + "!"] if roll < 0.16 else [t]
    if size > 5 and rng.random() < 0.5:
        theirs.insert(rng.randrange(len(theirs) + 1), theirs.pop(rng.randrange(len(theirs)))) if theirs else None
    number = lambda lines: [(i + 1, t) for i, t in enumerate(lines)]
    return number(ours), number(theirs)


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_equals_brute_force(spark, block):
    rng = random.Random(7)
    files = {f"f{i}": edited(rng, rng.choice([0, 1, 2, 5, 20, 60])) for i in range(60)}
    files["twice"] = ([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (3, "d")], [(1, "x"), (2, "y"), (3, "b"), (4, "d"), (4, "e")])
    lines = lambda side: spark.createDataFrame([("M", f, n, t) for f, pair in files.items() for n, t in pair[side]],
                                               "market string, source_file string, _row bigint, _fp string")
    cut = lambda df: materialize(df, "test-alignment")
    same, pairs = alignment.align_lines(lines(0), lines(1), cut, block)
    got = {f: {} for f in files}
    for r in pairs.collect():
        assert (r["_row"], r["_fp"]) not in got[r.source_file]
        got[r.source_file][r["_row"], r["_fp"]] = (r["_raw_row"], r["_raw_fp"], r.match_kind)
    alike = {r.source_file for r in same.collect()}
    assert alike == {f for f, (p, q) in files.items() if p and p == q}
    kinds = set()
    for f, (p, q) in files.items():
        if f not in alike:
            want = brute(p, q)
            assert got[f] == want, f
            kinds |= {v[2] for v in want.values()}
            assert len({v[:2] for v in want.values()}) == len(want)  # a raw line is taken once
    assert kinds == {"unique", "extended", "repeated", "position"}


def raw_rows(spark, rows):
    line = lambda d: "\t".join(d.get(f, "") for f in SOURCE_FIELDS["matching"])
    return spark.createDataFrame([(m, f, n, line(d) if isinstance(d, dict) else d) for m, f, n, d in rows],
                                 "market string, source_file string, file_row_number bigint, raw_data string")


def test_rows_nulls_and_repeats(spark):
    f = "MATCHING/USA/a.tsv"
    parsed = bronze(spark, "matching", [
        {"market": " usa", "source_file": f, "file_row_number": 1, "id_outlet": "1"},
        {"market": "USA", "source_file": f, "file_row_number": 1, "id_outlet": "1"},          # the row again
        {"market": "USA", "source_file": f, "file_row_number": 2, "id_outlet": "2", "sd": None},
        {"market": "USA", "source_file": f, "file_row_number": None, "id_outlet": "2"},
        {"market": None, "source_file": f, "file_row_number": 2, "id_outlet": "2"},
        {"market": "USA", "source_file": "MATCHING/USA/none.tsv", "file_row_number": 1},
    ]).withColumn("block", F.lit("kept"))
    raw = raw_rows(spark, [("usa ", f, 1, {"id_outlet": "new"}), ("USA", f, 2, {"id_outlet": "1"}), ("USA", f, 3, {"id_outlet": " 2 ", "sd": "NULL"}),
                           ("USA", f, 4, None), (None, f, 2, {"id_outlet": "2"})])
    out = alignment.attach_aligned(parsed, raw, "matching")
    assert out.columns == [*parsed.columns, "raw_row_number", "raw_record", "match_kind"]
    got = sorted((str(r.market), r.source_file[-6:], r.file_row_number or 0, r.raw_row_number or 0, r.match_kind, r.block) for r in out.collect())
    assert got == [("None", "/a.tsv", 2, 0, "none", "kept"), ("USA", "/a.tsv", 0, 0, "none", "kept"), ("USA", "/a.tsv", 1, 2, "unique", "kept"),
                   ("USA", "/a.tsv", 1, 2, "unique", "kept"), ("USA", "/a.tsv", 2, 3, "unique", "kept"), ("USA", "ne.tsv", 1, 0, "none", "kept")]
    assert {r.raw_record.split("\t")[0] for r in out.filter("raw_row_number = 3").collect()} == {" 2 "}


def test_empty_tables(spark):
    parsed, raw = bronze(spark, "matching", [{"id_outlet": "1"}]), raw_rows(spark, [("USA", "x", 1, "1")])
    assert alignment.attach_aligned(parsed.limit(0), raw, "matching").count() == 0
    assert [r.match_kind for r in alignment.attach_aligned(parsed, raw.limit(0), "matching").collect()] == ["none"]


def test_files_that_agree_are_not_aligned(spark):
    rows = [{"file_row_number": i, "id_outlet": str(i % 3)} for i in range(1, 9)]
    raw = raw_rows(spark, [("usa", "MATCHING/USA/a.tsv", r["file_row_number"], {"id_outlet": r["id_outlet"]}) for r in rows])
    out = alignment.attach_aligned(bronze(spark, "matching", rows), raw, "matching").collect()
    assert {(r.file_row_number, r.raw_row_number, r.match_kind) for r in out} == {(i, i, "same") for i in range(1, 9)}


def test_inputs_are_read_once(spark):
    """Both sides feed several steps, and neither may be made for each of them."""
    rows = [{"file_row_number": i, "id_outlet": str(i % 5)} for i in range(1, 21)]
    made = {side: spark.sparkContext.accumulator(0) for side in ("parsed", "raw")}

    def counted(side, column):
        seen = made[side]

        def count(text):
            seen.add(1)
            return text
        return F.udf(count, "string").asNondeterministic()(column)

    parsed = bronze(spark, "matching", rows).withColumn("id_outlet", counted("parsed", "id_outlet"))
    raw = raw_rows(spark, [("usa", "MATCHING/USA/a.tsv", r["file_row_number"] + 1, {"id_outlet": r["id_outlet"]}) for r in rows])
    raw = raw.withColumn("raw_data", counted("raw", "raw_data"))
    out = alignment.attach_aligned(parsed, raw, "matching").collect()
    assert {(r.file_row_number, r.raw_row_number, r.id_outlet) for r in out} == {(i, i + 1, str(i % 5)) for i in range(1, 21)}
    assert {side: seen.value for side, seen in made.items()} == {"parsed": 20, "raw": 20}
