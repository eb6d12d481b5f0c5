import math
import random
import re

import numpy as np
import pytest
from cases import clashing, documents, vocabulary

from stratum.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, top=10):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = [(i, TERM.findall(lower(t))) for i, t in docs]
    full = [w for _, w in words if w]
    n_docs, length = len(full), sum(map(len, full))
    df = {}
    for w in full:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for doc_id, w in words:
            score = 0
            for t in TERM.findall(lower(text)):
                if t in w:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * ((10**9 * w.count(t)) // (1000 * w.count(t) + 8 * (25 + (75 * len(w) * n_docs) // length)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id, score))
        out += [(item, rank + 1, f[2], f[3]) for rank, f in enumerate(sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:top])]
    return sorted(out, key=str)


def data():
    r, v = random.Random(8), vocabulary(150)
    docs = [(i, ", ".join(r.choices(v, weights=range(1, 151), k=r.choice([1, 4, 30, 120])))) for i in range(250)]
    docs += [(900, None), (901, ""), (902, "?! -- \u0001"), (903, "Ünïcode  Straße 12a"), (5, docs[5][1]), (None, docs[6][1]), (None, docs[6][1]), (904, docs[6][1]),
             (905, (v[3] + " ") * 5000 + v[9])]
    items = [(i, " ".join(r.choices(v, k=r.choice([1, 3, 12])))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "nowhere-to-be-found"), (53, docs[6][1]), (54, f"{v[3].upper()} {v[3]} {v[3]}"), (3, "straße ünïcode"), (3, "straße ünïcode"), (None, v[9])]
    return docs, items


@pytest.mark.parametrize(("block", "top"), [(1 << 20, 10), (300, 3)])
def test_search_matches_brute_force(spark, block, top):
    docs, items = data()
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = ranked.search(clashing(documents(spark, docs)).repartition(5), clashing(table), top, block).collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs, items, top)


def test_bounds_hold_and_few_buckets_stay_exact(monkeypatch):
    docs, items = data()
    monkeypatch.setattr(ranked, "BUCKETS", 8)
    texts = [t for _, t in docs]
    held = [ranked.terms(t) for t in texts]
    df = {}
    for w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    corpus = ranked.Corpus(sum(map(bool, held)), sum(map(len, held)), df)
    batch = ranked._Batch(texts, corpus)
    for at, (_, text) in enumerate(items):
        q = ranked._query(at, text, corpus)
        every = batch.scores(q, np.arange(len(docs)))
        assert (batch.bounds(q) >= every).all()
        best = ranked._Best(10)
        ranked.offer(batch, q, [i for i, _ in docs], best)
        assert sorted(e[0] for e in best.heap) == sorted(s for s in every.tolist() if s > 0)[-10:]


def test_rescoring_stops_at_the_threshold():
    r = random.Random(1)
    texts = [f"rare{i} rare{i} common" if i < 20 else "common " + " ".join(f"w{r.randrange(500)}" for _ in range(60)) for i in range(400)]
    df = {b"common": 400, **{b"rare%d" % i: 1 for i in range(20)}}
    corpus = ranked.Corpus(400, sum(len(ranked.terms(t)) for t in texts), df)
    q = ranked._query(0, "common " + " ".join(f"rare{i}" for i in range(20)), corpus)
    assert ranked.offer(ranked._Batch(texts, corpus), q, list(range(400)), ranked._Best(10)) < 100


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(documents(spark, [(1, "a")]), none).collect() == []
    assert ranked.search(documents(spark, []), one).collect() == []
    assert ranked.search(documents(spark, [(1, None)]), one).collect() == []
    # one document of one term: ln(4/3) * 1000 = 287, impact 10**9 // (1000 + 8 * 100)
    assert [tuple(r) for r in ranked.search(documents(spark, [(1, "a")]), one).collect()] == [(1, 1, 1, 287 * 555555)]
