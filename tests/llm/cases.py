"""Small tables with nulls, empty and long texts, ties, repeated rows and
columns whose names clash with those that the operators use inside."""

import random

CLASH = ["key", "rank", "size", "bucket", "cum", "x", "n", "sig", "region", "shard", "_row", "part", "weight", "label", "_id", "_t", "_digest", "_copies", "_copy", "_size", "_source", "t", "c", "m"]


def vocabulary(n=400, seed=3):
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghijklmnopqrstuvwxyzé", k=r.randint(2, 9))) for _ in range(n)]


def texts(n=60, seed=5):
    """Invented texts with exact copies, copies with few and with many edits."""
    r, v = random.Random(seed), vocabulary()
    out = [" ".join(r.choices(v, k=r.choice([1, 2, 3, 8, 40, 150]))) for _ in range(n)]
    for i in range(0, n, 3):
        w = out[i].split(" ")
        for edits in (0, 1, 2, 4, 8):
            c = list(w)
            for _ in range(edits):
                c[r.randrange(len(c))] = r.choice(v)
            out.append(" ".join(c))
    return out


def clashing(df):
    """``df`` with extra columns of names that operators use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(1).alias(c) for c in CLASH if c not in df.columns))


def documents(spark, rows):
    """Rows (doc_id, text[, source]) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


def closure(ids, links):
    """Smallest id reached from each id."""
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}
