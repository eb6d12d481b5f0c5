from cases import clashing, documents, texts

from stratum.llm import mixing


def water(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return {**{s: most * sizes[s] for s in capped}, **share}
        capped |= set(above)


def rows():
    t = texts(200)
    some = [(i, x, ["big", "b", None, "é", "z", "tiny"][0 if i % 3 == 0 else i % 6]) for i, x in enumerate(t)]
    return some + [(1000, None, "big"), (1001, "", "b"), (1002, " ", "void"), (1003, "one two", "mini")]


def test_targets_and_taken(spark):
    data = rows()
    out = mixing.mix(clashing(documents(spark, data)).repartition(3)).collect()
    size = {i: len((t or "").encode().split()) for i, t, _ in data}
    source = {i: s for i, _, s in data}
    sizes = {}
    for i, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[i]
    goal, taken = water(sizes), dict.fromkeys(sizes, 0)
    assert len(out) == len(data)
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and abs(r["target"] - goal[s]) < 1e-6
        assert r["taken"] == r["size"] * r["copies"] and r["copies"] <= 3
        taken[s] += r["taken"]
    assert sum(taken.values()) <= sum(sizes.values())
    assert all(abs(taken[s] - goal[s]) <= 2 * max(size.values()) for s in sizes)


def test_reruns_and_other_layouts_agree(spark):
    df = documents(spark, rows())
    first = sorted(map(tuple, mixing.mix(df).collect()))
    assert first == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()))


def test_many_buckets_give_the_same_mix(spark, monkeypatch):
    df = documents(spark, rows())
    first = sorted((r["doc_id"], r["target"]) for r in mixing.mix(df).collect())
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 20)
    many = mixing.mix(df).collect()
    assert sorted((r["doc_id"], r["target"]) for r in many) == first
    assert sum(r["taken"] for r in many) <= sum(r["size"] for r in many)


def test_mixed_documents(spark):
    df = documents(spark, rows())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(df).collect()}
    got = mixing.mixed(df)
    assert got.columns == df.columns
    count = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert count == {i: n for i, n in copies.items() if n}


def test_repeated_rows_and_empty_table(spark):
    out = mixing.mix(documents(spark, [(1, "a b", "s"), (1, "a b", "s"), (None, "c", None)])).collect()
    assert len(out) == 3
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed(documents(spark, [])).count() == 0


def test_mixed_takes_single_rows(spark):
    data = rows()
    data += [(None, x, s) for _, x, s in data[:60]] + [(i, f"{x} and more", s) for i, x, s in data[:40]]
    df = documents(spark, data)
    want = {}
    for r in mixing.mix(df).collect():
        want[r["doc_id"], r["size"]] = want.get((r["doc_id"], r["size"]), 0) + r["copies"]
    got = {}
    for r in mixing.mixed(df).collect():
        at = r["doc_id"], len((r["text"] or "").encode().split())
        got[at] = got.get(at, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
