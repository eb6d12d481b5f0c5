import random

from cases import clashing, documents, vocabulary
from pyspark.sql import functions as F

from stratum.llm import licenses


def brute(text, templates, least=0.8):
    import re

    def grams(t):
        w = re.sub(r"[^\w]+|_", " ", t.lower()).split()
        return set(zip(w, w[1:], strict=False))

    w = re.sub(r"[^\w]+|_", " ", (text or "").lower()).split()
    found = []
    for name, t in templates.items():
        both, m = grams(t), len(re.sub(r"[^\w]+|_", " ", t.lower()).split())
        best = 0.0
        for s in range(max(1, len(w) - m + 1)):
            g = set(zip(w[s: s + m], w[s + 1: s + m], strict=False))
            if g & both:
                best = max(best, 2 * len(g & both) / (len(g) + len(both)))
        if both and best >= least - 1e-12:
            found.append((name, best))
    return len(found), ",".join(sorted(n for n, _ in found)), max((d for _, d in found), default=0.0)


def edited(r, v):
    words = r.choice(list(licenses.TEMPLATES.values())).split()
    for _ in range(r.choice([0, 0, 1, 2, 4])):
        k = r.randrange(len(words))
        words[k: k + 1] = r.choice([[], [r.choice(v)], [words[k], r.choice(v)]])
    return r.choice([" ", "\n", "  "]).join(words) if r.random() < 0.2 else " ".join(words).upper() if r.random() < 0.3 else " ".join(words)


def test_matches_brute_force(spark):
    r, v = random.Random(4), vocabulary()
    texts = [None, "", "MIT", "All rights reserved", "Rights\nreserved", licenses.TEMPLATES["MIT-text"].replace(", ", ",\n")]
    for _ in range(150):
        lines = [" ".join(r.choices(v, k=r.randint(0, 12))) for _ in range(r.randint(0, 5))]
        for _ in range(r.choice([0, 1, 1, 2])):
            lines.insert(r.randint(0, len(lines)), edited(r, v))
        texts.append(r.choice(["\n", "\r\n", "\n\n"]).join(lines))
    texts.append("word " * 50_000 + "\nReleased under the MIT License.")
    rows = licenses.scan(clashing(documents(spark, [*enumerate(texts), (5, texts[5])]))).collect()
    assert len(rows) == len(texts) + 1
    assert sum(x["n_matches"] > 0 for x in rows) > 60
    for x in rows:
        n, names, best = brute(texts[x["doc_id"]], licenses.TEMPLATES)
        assert (x["n_matches"], x["licenses"]) == (n, names) and abs(x["best_dice"] - best) < 1e-12


def test_native_plan(spark):
    plan = licenses.scan(documents(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table_and_no_templates(spark):
    assert licenses.scan(documents(spark, [])).count() == 0
    assert licenses.scan(documents(spark, [(1, "All rights reserved.")]), templates={"none": "one"}).first()["n_matches"] == 0


def test_notices_inside_sentences_and_comments(spark):
    body = "Licensed under the Apache License, Version 2.0 (the 'License'); you may not use this file except in compliance with the License. " \
           "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    words = body.split()
    block = "/*\n" + "\n".join(" * " + " ".join(words[i: i + 6]) + "\n *" for i in range(0, len(words), 6)) + "\n */"
    texts = ["The code was Released under the MIT License. See the project page for more.",
             "This module is Licensed under the Apache License, Version 2.0. See the file LICENSE.", block, "# x\n" + "\n#\n# ".join(licenses.TEMPLATES["MIT-text"].split(", "))]
    got = {x["doc_id"]: x for x in licenses.scan(documents(spark, list(enumerate(texts)))).collect()}
    assert got[0]["licenses"] == "MIT" and got[0]["best_dice"] == 1.0
    assert "Apache-2.0" in got[1]["licenses"].split(",")
    assert "Apache-2.0-header" in got[2]["licenses"].split(",") and got[2]["best_dice"] == 1.0
    assert got[3]["licenses"] == "MIT-text"
    first = documents(spark, [(0, "a b c " + texts[0])]).select(licenses.matches(F.col("text")).alias("m")).first()["m"]
    assert [(m["license"], m["start"], m["passage"]) for m in first] == [("MIT", 6, "released under the mit license")]
