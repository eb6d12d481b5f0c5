import random
import zlib

import numpy as np
from cases import clashing, documents, vocabulary
from pyspark.sql import functions as F

from stratum.llm import toxicity

LABEL = "doc_id long, quality int, toxic int"
BAD = ["grumpfidiot", "snarlscum", "vexloser", "blightfool"]


def data(n=900):
    r, v = random.Random(6), vocabulary(600)
    docs, labels = [], []
    for i in range(n):
        words = r.choices(v, k=r.choice([20, 80, 300]))
        toxic = i % 8 == 0
        if toxic:
            for w in r.sample(BAD, 2):
                words.insert(r.randrange(len(words)), w + r.choice(["", "s", "ish", "."]))
        docs.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_contract(spark):
    docs, labels = data()
    extra = [(5000, None), (5001, ""), (None, "clean words only"), (3, docs[3][1]), (5002, "word " * 30_000 + "snarlscum vexlosers")]
    df = clashing(documents(spark, docs + extra))
    model = toxicity.fit(df, spark.createDataFrame(labels + [(None, 1, 1), (7, 1, None), (16, 1, 0)], LABEL))
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(docs) + len(extra)
    for x in rows:
        assert x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1)
        assert 0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7)
    held = [x for x in rows if x["held_out"] and x["doc_id"] < 900]
    toxic = [x["predicted"] for x in held if x["doc_id"] % 8 == 0]
    clean = [x["predicted"] for x in held if x["doc_id"] % 8]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    assert [x["predicted"] for x in rows if x["doc_id"] == 5002] == [1]
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == sorted(str(x["doc_id"]) for x in rows if not x["predicted"])


def test_scores_depend_on_the_text_alone(spark):
    docs, labels = data(300)
    df, known = documents(spark, docs), spark.createDataFrame(labels, LABEL)
    model = toxicity.fit(df, known)
    other = df.select((F.col("doc_id") + 7000).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("q").alias("source"), "n_chars")
    assert sorted(x["score"] for x in toxicity.score(df, model).collect()) == sorted(x["score"] for x in toxicity.score(other, model).collect())


def test_held_out_labels_are_not_learned(spark):
    docs, labels = data(300)
    df = documents(spark, docs)
    flipped = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    a, b = (toxicity.fit(df, spark.createDataFrame(x, LABEL)) for x in (labels, flipped))
    assert a == b


def test_non_negative_risk_separates():
    r = np.random.default_rng(1)
    p = (r.random((200, 6)) < [0.9, 0.8, 0.5, 0.5, 0.5, 0.5]).astype(np.float32)
    u = np.concatenate([(r.random((60, 6)) < [0.9, 0.8, 0.5, 0.5, 0.5, 0.5]), (r.random((540, 6)) < [0.02, 0.02, 0.5, 0.5, 0.5, 0.5])]).astype(np.float32)
    w, bias = toxicity.nnpu(p, u, 0.1, 600, 0.05, 1e-4)
    assert w[0] > 1 and w[1] > 1 and abs(w[2:]).max() < w[:2].min()
    assert bias < 0


def test_no_positive_labels_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    model = toxicity.fit(docs, spark.createDataFrame([(1, 1, 0)], LABEL))
    assert [x["predicted"] for x in toxicity.score(docs, model).collect()] == [0, 0]
    model = toxicity.fit(documents(spark, []), spark.createDataFrame([], LABEL))
    assert toxicity.score(documents(spark, []), model).count() == 0 and toxicity.keep_clean(docs, model).count() == 2


def test_many_rows_of_one_id_stay_within_the_sample(spark, monkeypatch):
    docs, labels = data(300)
    monkeypatch.setattr(toxicity, "MOST_UNLABELLED", 50)
    monkeypatch.setattr(toxicity, "MOST_POSITIVE", 20)
    seen = []
    monkeypatch.setattr(toxicity, "nnpu", lambda p, u, *_: (seen.append((len(p), len(u))), (np.zeros(p.shape[1]), 0.0))[1])
    rows = docs + [(docs[0][0], f"{docs[0][1]} {i}") for i in range(400)] + [docs[1]] * 300
    toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, LABEL))
    assert seen[0][0] <= 20 and seen[0][1] <= 50


def test_scores_and_term_counts_in_plain_python(spark):
    docs, labels = data(400)
    model = toxicity.fit(documents(spark, docs), spark.createDataFrame(labels, LABEL))
    for x in toxicity.score(documents(spark, docs), model).collect():
        z = model["bias"] + sum(model["weights"].get(t, 0.0) for t in toxicity.terms(docs[x["doc_id"]][1]))
        assert abs(x["score"] - 1 / (1 + np.exp(-z))) < 1e-9
    # the vocabulary by the same test, counted here over all documents of the fold
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    train = [set(toxicity.terms(t)) for i, t in docs if not out(i)]
    toxic = {i for i, _, t in labels if t == 1 and not out(i)}
    pos = [set(toxicity.terms(t)) for i, t in docs if i in toxic]
    prior = len(toxic) / sum(not out(i) for i, _, _ in labels)
    chosen = set()
    for t in set().union(*pos):
        p, u = sum(t in d for d in pos), sum(t in d for d in train)
        share = (max(u / len(train) - prior * p / len(pos), 0) + 0.5 / len(train)) / (1 - prior)
        if (p - len(pos) * share) / (len(pos) * share * max(1 - share, 0) + 0.25) ** 0.5 >= toxicity.LEAST_SIGMA:
            chosen.add(t)
    assert chosen and set(model["weights"]) == chosen


def test_risk_gradient_by_finite_differences():
    r = np.random.default_rng(2)
    p, u = (r.random((n, 3)) < 0.4 for n in (30, 50))
    p, u = p.astype(np.float64), u.astype(np.float64)
    prior, w0 = 0.2, np.array([0.3, -0.2, 0.1, -0.5])
    s = lambda x, w: 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    risk = lambda w: prior * -np.log(s(p, w)).mean() + max(0.0, -np.log(1 - s(u, w)).mean() - prior * -np.log(1 - s(p, w)).mean())
    numeric = np.array([(risk(w0 + 1e-6 * e) - risk(w0 - 1e-6 * e)) / 2e-6 for e in np.eye(4)])
    p1, u1 = np.hstack([p, np.ones((30, 1))]), np.hstack([u, np.ones((50, 1))])
    exact = prior * p1.T @ (s(p, w0) - 1) / 30 + u1.T @ s(u, w0) / 50 - prior * p1.T @ s(p, w0) / 30
    assert np.allclose(numeric, exact, atol=1e-5)
    # one step of the fit goes against the gradient
    w, b = toxicity.nnpu(p.astype(np.float32), u.astype(np.float32), prior, 1, 0.01, 0.0)
    zero = prior * p1.T @ (0.5 - np.ones(30)) / 30 + u1.T @ np.full(50, 0.5) / 50 - prior * p1.T @ np.full(30, 0.5) / 30
    assert np.array_equal(np.sign(np.append(w, b)), -np.sign(zero))
