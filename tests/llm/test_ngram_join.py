import pytest
from cases import clashing, closure, documents, texts

from stratum.llm import ngram_join


def brute(rows, k, least):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = {}
    for i, t in rows:
        sets.setdefault(i, grams(t))
    ids = sorted(i for i in sets if i is not None)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, closure(ids, links), links


def degrees(ids, links):
    out = dict.fromkeys(ids, 0)
    for a, b in links:
        out[a] += 1
        out[b] += 1
    return out


ROWS = [(i * 3, t) for i, t in enumerate(texts())] + [(1, None), (2, ""), (4, " \t\r\n"), (5, "one"), (7, "ONE"), (8, "one two"), (10, "a b c d " * 4000), (11, "a b c d " * 4000 + "e")]


@pytest.mark.parametrize(("k", "least"), [(3, 90), (5, 80), (2, 50)])
def test_components_match_brute_force(spark, k, least):
    n, comp, links = brute(ROWS, k, least)
    assert len(links) > 20
    rows = ngram_join.near_duplicates(clashing(documents(spark, ROWS + ROWS[:3])).repartition(3), k, least).collect()
    assert len(rows) == len(ROWS) + 3
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (n[i], comp[i]) for i in n}
    assert {r["doc_id"]: r["n_links"] for r in ngram_join.near_duplicates(documents(spark, ROWS), k, least).collect()} == degrees(n, links)


@pytest.mark.parametrize("how", [{"leaf": 1500, "leaf_docs": 6, "pivots": 3}, {"leaf": 400, "leaf_docs": 3, "pivots": 4}])
def test_large_regions_split_without_losing_links(spark, how):
    n, comp, links = brute(ROWS, 3, 80)
    rows = ngram_join.near_duplicates(documents(spark, ROWS), 3, 80, **how).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == comp
    assert {r["doc_id"]: r["n_links"] for r in rows} == degrees(n, links)


def test_region_join_paths_agree():
    import numpy as np

    from stratum.llm.common import hashes, shingles, words

    sets = [shingles(hashes(words(t)), 3) for t in texts() if len(t.split()) > 30]
    ids = list(range(len(sets)))
    want = closure(ids, [(a, b) for a in ids for b in ids[a + 1:]
                         if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))])
    assert closure(ids, ngram_join.join_region(ids, sets, 80)) == want
    for size in (2, 5, 9):
        part = closure(ids[:size], ngram_join.join_region(ids[:size], sets[:size], 80))
        assert part == closure(ids[:size], [(a, b) for a in ids[:size] for b in ids[a + 1: size]
                                            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))])


@pytest.mark.parametrize("bits", [1 << 27, 0])
def test_counted_links_match_brute_force(monkeypatch, bits):
    import random

    import numpy as np

    monkeypatch.setattr(ngram_join, "MOST_BITS", bits)
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(40)]
    sets = [np.unique(np.array([x for x in base if r.random() > 0.06] + [r.getrandbits(64) for _ in range(r.choice([0, 1, 3]))], np.uint64)) for _ in range(60)]
    copies = np.array([r.choice([1, 1, 4]) for _ in sets])
    for side in (np.full(60, -1), np.array([r.randrange(2) for _ in sets])):
        want = [sum(int(copies[j]) for j in range(60) if j != i and (side[i] < 0 or side[i] != side[j])
                    and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))) for i in range(60)]
        assert sum(want) > 100 and ngram_join.count_links(sets, copies, side, 80).tolist() == want


def test_linked_sets_share_a_signature():
    import random

    import numpy as np

    r, plan = random.Random(1), ngram_join.classes(80)
    for _ in range(300):
        n = r.choice([2, 5, 9, 10, 30, 100, 900])
        a = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
        drop = r.randrange(0, n // 5 + 1)
        add = r.randrange(0, n // 5 + 1)
        b = np.unique(np.concatenate([a[drop:], np.array([r.getrandbits(64) for _ in range(add)], np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 0 < common < max(len(a), len(b)) and 100 * common >= 80 * (len(a) + len(b) - common):
            assert set(ngram_join.signatures(a, 80, plan)) & set(ngram_join.signatures(b, 80, plan))


def test_null_ids_and_empty_table(spark):
    rows = ngram_join.near_duplicates(documents(spark, [(None, "a b c"), (None, "a b c"), (3, "a b c"), (2, "a b c")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows if r["doc_id"]) == [(2, 2), (3, 2)]
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    assert ngram_join.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one(spark):
    _, comp, _ = brute(ROWS, 5, 80)
    kept = ngram_join.keep_one(documents(spark, ROWS + ROWS[:4] + [(None, "x y")]))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(comp.values()))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_keep_one_decides_by_row(spark):
    t = [x for x in texts() if len(x.split()) >= 40]
    near = t[1] + " more"
    other = " ".join(f"w{i}" for i in range(30))
    rows = [(1, t[1]), (5, near), (5, other), (7, "x y z"), (7, other + " again and again and again"), (8, ""), (8, "q"), (9, None), (9, "q r"), (9, "q r"), (None, near), (None, near)]
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in ngram_join.keep_one(documents(spark, rows)).collect()))
    want = [r for r in rows if r not in ((5, near), (7, other + " again and again and again"))]  # copies of 1 and of (5, other)
    want.remove((9, "q r"))
    assert got == sorted((i or 0, x or "") for i, x in want)
    kept = ngram_join.keep_one(documents(spark, [(3, t[1]), (3, near), (4, near)])).collect()
    assert [r["doc_id"] for r in kept] == [3]


def test_keep_one_with_maps_and_clashing_names(spark):
    from pyspark.sql import functions as F

    t = next(x for x in texts() if len(x.split()) >= 40)
    df = clashing(documents(spark, [(1, t), (1, t), (2, t + " more"), (3, "other words")])).withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id")))
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
