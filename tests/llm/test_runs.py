import hashlib
import random
import zlib

import numpy as np
from cases import clashing, documents, vocabulary

from stratum.llm import runs


def brute_runs(x, least):
    """Every period, every stretch of equal words that far apart."""
    n, seen = len(x), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if x[i] != x[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and x[j] == x[j + p]:
                j += 1
            if j - i >= p:
                seen.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in seen.items() if e - s >= max(least, 2 * p))


def brute_row(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w, 12)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_random_sequences():
    r = random.Random(2)
    for _ in range(600):
        n, letters = r.randint(0, 70), r.choice([1, 2, 3, 6])
        x = [r.randrange(letters) for _ in range(n)]
        if r.random() < 0.6 and n > 5:
            p, s = r.randint(1, n // 3), r.randrange(n)
            x[s:] = (x[s: s + p] * n)[: n - s]
        for least in (2, 12):
            assert runs.runs(np.array([*x, letters], np.int64), least) == brute_runs(x, least)


def test_suffix_and_lcp_arrays():
    r = random.Random(4)
    for _ in range(50):
        x = [r.randrange(3) for _ in range(r.randint(1, 80))] + [3]
        order, place, levels = runs.suffix_array(np.array(x))
        assert order.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        assert place[order].tolist() == list(range(len(x)))
        lcp = runs.lcp_array(order, levels).tolist()
        for k in range(1, len(x)):
            a, b = x[order[k - 1]:], x[order[k]:]
            assert lcp[k] == next((i for i, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))


def rows():
    r, v = random.Random(9), vocabulary(60)
    out = []
    for i in range(120):
        w = r.choices(v, k=r.choice([1, 5, 30, 200]))
        if i % 3 == 0:
            at, p = r.randrange(len(w)), r.choice([1, 2, 3, 7, 20])
            unit = r.choices(v, k=p)
            w[at:at] = unit * r.choice([2, 3, 6, 13]) + unit[: r.randrange(p + 1)]
        out.append((i, " ".join(w)))
    return out + [(500, None), (501, ""), (502, " \t\r\n\x0b\x0c"), (503, "a a " * 30), (504, "one"), (505, "na " * 3000), (506, "A a " * 20), (7, out[7][1]), (7, out[8][1]), (None, "x y " * 9)]


def test_scan_matches_brute_force(spark):
    got = runs.scan(clashing(documents(spark, rows())).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_row(*r) for r in rows()), key=str)
    assert sum(r["n_runs"] > 0 for r in got) > 30
    assert runs.scan(documents(spark, [])).collect() == []


def test_long_periodic_text_and_small_batches(monkeypatch):
    found = runs.runs(np.array([0, 1, 2] * 40_000 + [3]))
    assert found == [(0, 120_000, 3)]
    whole = list(runs._documents(*zip(*rows())))
    monkeypatch.setattr(runs, "BATCH_WORDS", 50)
    assert list(runs._documents(*zip(*rows()))) == whole
