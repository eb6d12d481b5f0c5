import itertools
import random
import zlib

import numpy as np
from cases import clashing, documents, vocabulary
from pyspark.sql import functions as F

from stratum.llm import line_quality as lq

LABEL = "doc_id long, quality int, toxic int"


def data(n=500):
    r, v = random.Random(6), vocabulary(500)
    docs, labels = [], []
    for i in range(n):
        lines = [" ".join(r.choices(v, k=r.choice([4, 12, 30]))).capitalize() + "." for _ in range(r.choice([1, 3, 8]))]
        bad = i % 4 == 0
        if bad:
            for at in range(len(lines)):
                if at == 0 or r.random() < 0.8:
                    w = lines[at].split()
                    lines[at] = r.choice([" ".join(x + "@@" for x in w), " / ".join(w), " ".join(w).upper(), " ".join([w[0]] * 30)])
        docs.append((i, "\n".join(lines)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not bad), 0))
    return docs, labels


def test_held_out_accuracy_and_contract(spark):
    docs, labels = data()
    extra = [(5000, None), (5001, ""), (None, "Some words."), (3, docs[3][1]), (5002, "\n" * 3000), (5003, (docs[4][1] + "\n") * 400)]
    df = clashing(documents(spark, docs + extra))
    model = lq.fit(df, spark.createDataFrame(labels + [(None, 0, 0), (9, None, 0), (6, 1, 0)], LABEL))
    rows = lq.score(df, model).collect()
    assert len(rows) == len(docs) + len(extra)
    for x in rows:
        assert x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0)
        assert 0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3)
    held = [x for x in rows if x["held_out"] and x["doc_id"] < 500]
    bad = [1 - x["predicted"] for x in held if x["doc_id"] % 4 == 0]
    good = [x["predicted"] for x in held if x["doc_id"] % 4]
    assert len(bad) > 15 and sum(bad) >= 0.9 * len(bad) and sum(good) >= 0.95 * len(good)
    assert len({x["score"] for x in rows if x["doc_id"] == 3}) == 1
    assert lq.score(documents(spark, []), model).collect() == []


def test_scores_read_the_text_alone(spark):
    docs, labels = data(200)
    df = documents(spark, docs)
    model = lq.fit(df, spark.createDataFrame(labels, LABEL))
    other = df.select((F.col("doc_id") + 7000).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit("q").alias("source"), "n_chars").repartition(2)
    assert np.allclose(sorted(x["score"] for x in lq.score(df, model).collect()), sorted(x["score"] for x in lq.score(other, model).collect()), atol=1e-12)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = data(200)
    df = documents(spark, docs)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (lq.fit(df, spark.createDataFrame(x, LABEL)) for x in (labels, flipped))
    assert np.array_equal(a.own, b.own) and a.curve == b.curve


def test_one_label_only_scores_one(spark):
    docs, labels = data(60)
    only = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], LABEL)
    assert lq.fit(documents(spark, docs), only) is None
    assert {x["score"] for x in lq.score(documents(spark, docs), None).collect()} == {1.0}
    assert lq.fit(documents(spark, []), only) is None


def _chains(sizes, seed):
    r = np.random.default_rng(seed)
    return r.normal(size=sum(sizes)), r.normal(size=3), np.cumsum([0, *sizes])[:-1]


def test_marginals_match_enumeration():
    sizes = [1, 4, 2, 5, 3]
    u, change, first = _chains(sizes, 3)
    got = lq.forward_backward(u, change, first)
    bg, gb, gg = change
    for at, n in zip(first, sizes):
        weight, good, pairs = 0.0, np.zeros(n), np.zeros((n, 3))
        for y in itertools.product((0, 1), repeat=n):
            s = sum(u[at + i] for i in range(n) if y[i]) + sum({(0, 1): bg, (1, 0): gb, (1, 1): gg, (0, 0): 0.0}[y[i - 1], y[i]] for i in range(1, n))
            e = np.exp(s)
            weight += e
            good += e * np.array(y)
            for i in range(1, n):
                for j, p in enumerate([(0, 1), (1, 0), (1, 1)]):
                    pairs[i, j] += e * ((y[i - 1], y[i]) == p)
            if all(y):
                all_good = s
        k = list(first).index(at)
        assert np.allclose(got.good[at: at + n], good / weight) and np.allclose(got.pairs[at: at + n], pairs / weight)
        assert np.isclose(got.all_good[k], all_good - np.log(weight)) and np.isclose(got.all_bad[k], -np.log(weight))


def test_gradient_matches_finite_differences():
    r = np.random.default_rng(5)
    sizes = [1, 3, 6, 2]
    first = np.cumsum([0, *sizes])[:-1]
    bins = r.integers(0, lq.BINS, (sum(sizes), 2)).astype(np.int16)
    label, share = np.array([1, 0, 0, 1]), np.array([0.3, 0.2, 0.1, 0.4])
    w = [r.normal(size=(2, lq.BINS)) * 0.3 for _ in range(3)] + [np.array(0.2), np.array(-0.1), r.normal(size=3) * 0.3]
    loss = lambda w: lq._gradient(lq.Model([], *w, (0, 0)), bins, first, label, share)[0]
    grad = lq._gradient(lq.Model([], *w, (0, 0)), bins, first, label, share)[1]
    for j, x in enumerate(w):
        for place in np.ndindex(x.shape):
            up, down = [y.copy() for y in w], [y.copy() for y in w]
            up[j][place] += 1e-5
            down[j][place] -= 1e-5
            assert np.isclose((loss(up) - loss(down)) / 2e-5, grad[j][place], atol=1e-6)


def test_line_features_of_a_batch_equal_those_of_each_text():
    texts = ["Ab cd!! @@ 12", None, "", "a a a\n\nÉÉ ß | x |\n", "\n", "tab\tword\r\nlast"]
    features, first, length = lq.line_features(texts)
    assert first.tolist() == [0, 1, 2, 3, 7, 9] and len(length) == 11
    for i, t in enumerate(texts):
        alone, _, size = lq.line_features([t])
        assert np.array_equal(alone, features[first[i]: first[i] + len(alone)]) and size.tolist() == [len(x) for x in (t or "").split("\n")]
