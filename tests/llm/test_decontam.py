import random

import numpy as np
from cases import clashing, documents, vocabulary

from stratum.llm import decontam

ITEM = "item_id long, text string, start int, score int"


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def data():
    r, v = random.Random(8), vocabulary(900)
    items = [(i, " ".join(r.choices(v, k=r.randint(12, 40)))) for i in range(12)] + [(50, "solo"), (51, None), (52, ""), (53, "two words")]
    docs, planted = [], set()
    for d in range(120):
        words = r.choices(v, k=r.choice([0, 5, 60, 400]))
        if d % 3 == 0:
            i = r.randrange(12)
            copy = items[i][1].split()
            for _ in range(len(copy) // 10):
                k = r.randrange(len(copy))
                copy[k: k + 1] = r.choice([[], [r.choice(v)], [copy[k].upper() + ",", r.choice(v)]])
            at = r.randint(0, len(words))
            words[at:at] = copy
            planted.add((d, i))
        docs.append((d, " ".join(words)))
    docs += [(500, None), (501, ""), (502, "Two. WORDS!"), (503, "so solo " * 3), (504, ("x y " * 20_000) + items[0][1])]
    return items, docs, planted


def test_alignment_is_smith_waterman():
    r = np.random.default_rng(0)
    for _ in range(60):
        a, b = r.integers(0, 5, r.integers(1, 15)).astype(np.uint64), r.integers(0, 5, r.integers(1, 30)).astype(np.uint64)
        assert decontam.align(a, b)[0] == smith_waterman(a, b)


def test_alignment_in_blocks_of_rows(monkeypatch):
    r = np.random.default_rng(3)
    for cells in (1, 40, 1 << 16):
        monkeypatch.setattr(decontam, "ALIGN_CELLS", cells)
        for _ in range(30):
            a, b = r.integers(0, 4, r.integers(1, 15)).astype(np.uint64), r.integers(0, 4, r.integers(1, 30)).astype(np.uint64)
            score, end = decontam.align(a, b)
            assert score == smith_waterman(a, b) == smith_waterman(a, b[:end])


def test_words_in_common_bound_the_alignments(monkeypatch):
    r = np.random.default_rng(5)
    for _ in range(60):
        a, b = r.integers(0, 6, r.integers(1, 15)).astype(np.uint64), r.integers(0, 6, r.integers(1, 30)).astype(np.uint64)
        both = decontam.Seeds([1], [a], 3).shared(0, b)
        assert both == sum(min(list(a).count(w), list(b).count(w)) for w in set(a))
        assert smith_waterman(a, b) <= decontam.MATCH * both
    # a window full of one word of the item isn't aligned
    monkeypatch.setattr(decontam, "align", lambda *_: 1 / 0)
    item = decontam.tokens("one two three four five six seven eight nine ten")
    assert decontam.Seeds([1], [item], 3).copies(decontam.tokens("one two three " + "four x " * 20), 0.9) == []


def test_copies_are_found_and_match_brute_force(spark):
    items, docs, planted = data()
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in items + items[:1]], ITEM)
    rows = decontam.contaminated(clashing(documents(spark, docs)), bench).collect()
    got = {(x["doc_id"], x["item_id"]): x for x in rows}
    assert planted <= set(got) and (504, 0) in got and (502, 53) in got and (503, 50) in got
    assert not {500, 501} & {d for d, _ in got} and len(rows) == len(got)
    text, item = dict(docs), dict(items)
    for (d, i), x in got.items():
        a, b = decontam.tokens(item[i]), decontam.tokens(text[d])
        if d != 504:
            assert abs(x["score"] * 2 * len(a) - smith_waterman(a, b)) < 1e-9
        assert x["score"] >= 0.5 and 0 <= x["start"] < x["end"] <= len(b)
    for d, t in docs:  # and nothing is missed that all pairs would show
        if d < 500 and d % 3:
            b = decontam.tokens(t)
            for i, s in items[:12]:
                assert ((d, i) in got) == (len(b) > 0 and smith_waterman(decontam.tokens(s), b) >= len(decontam.tokens(s)))


def test_frequent_items_stay_seeds(spark):
    items, docs, _ = data()
    many = [(1000 + k, f"intro {k} {items[3][1]} end") for k in range(200)]
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in items], ITEM)
    got = {x["doc_id"] for x in decontam.contaminated(documents(spark, docs + many), bench).collect() if x["item_id"] == 3}
    assert {d for d, _ in many} <= got


def test_passes_and_stage(spark, monkeypatch):
    items, docs, planted = data()
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in items], ITEM)
    df = documents(spark, docs + [(None, items[2][1]), (None, "clean")])
    whole = {(x["doc_id"], x["item_id"]) for x in decontam.contaminated(df, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 60)
    assert len(decontam._passes(bench, 3)) > 3
    assert {(x["doc_id"], x["item_id"]) for x in decontam.contaminated(df, bench).collect()} == whole
    kept = decontam.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == sorted([str(d) for d, _ in docs if d not in {d for d, _ in whole}] + ["None"])


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d", 0, 0)], ITEM)
    assert decontam.contaminated(documents(spark, []), bench).count() == 0
    assert decontam.contaminated(documents(spark, [(1, "a b c d")]), bench.limit(0)).count() == 0
    assert decontam.keep_clean(documents(spark, [(1, "a b c d")]), bench.limit(0)).count() == 1


def test_short_items_need_more_than_a_shared_phrase(spark):
    bench = spark.createDataFrame([(1, "the capital of France is Paris", 0, 0), (2, "yes", 0, 0), (3, "who wrote it first", 0, 0)], ITEM)
    tail = " ".join(f"w{i}" for i in range(40))
    docs = [(1, f"oslo became the capital of norway {tail}"), (2, f"she said yes and left {tail}"), (3, f"wrote it first {tail}"),
            (4, f"{tail} the capital of France was Paris"), (5, "Yes!"), (6, f"Who wrote it first? {tail}")]
    docs += [(d, tail) for d in range(10, 400)]  # so that grams of two documents are rare
    got = {(x["doc_id"], x["item_id"]) for x in decontam.contaminated(documents(spark, docs), bench).collect()}
    assert got == {(4, 1), (5, 2), (6, 3)}
    assert sorted(x["doc_id"] for x in decontam.keep_clean(documents(spark, docs), bench).collect()) == [1, 2, 3, *range(10, 400)]


def test_copies_with_long_insertions_are_found(spark):
    item = [f"i{k}" for k in range(40)]
    other = [f"o{k}" for k in range(200)]
    for gap in (25, 30, 33):
        copy = [*item[:9], "edit", *item[10:20], *other[:gap], *item[20:30], "edit", *item[31:]]
        text = " ".join([*other[50:90], *copy, *other[100:150]])
        score = smith_waterman(decontam.tokens(" ".join(item)), decontam.tokens(text))
        assert score >= 40
        bench = spark.createDataFrame([(1, " ".join(item), 0, 0)], ITEM)
        rows = decontam.contaminated(documents(spark, [(1, text)]), bench).collect()
        assert [x["score"] * 80 for x in rows] == [score]
