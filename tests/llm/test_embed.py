import random

import numpy as np
import pytest
from cases import closure

from stratum.llm import embed

SCHEMA = "vec_id long, embedding array<float>, label int, cell int, weight int, home boolean"


def data(n=300, dims=16, seed=2):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, dims))
    near = base[:80] + r.normal(size=(80, dims)) * 0.03
    copy = np.repeat(base[:1], 60, axis=0) * r.uniform(0.5, 2, size=(60, 1))
    same = np.repeat(base[1:2], 40, axis=0)
    x = np.concatenate([base, near, copy, same])
    lab = random.Random(1)
    rows = [(i, [float(np.float32(v)) for v in row], 0 if i < 80 or i >= n else lab.randrange(3)) for i, row in enumerate(x)]
    odd = [(9001, None, 1), (9002, [0.0] * dims, 1), (9003, [float("nan")] * dims, 1), (9004, [None] * dims, 1), (9005, rows[0][1], None),
           (9006, [float("inf")] * dims, 0), (9007, [1.0, 2.0], 0), (9008, [1.0, 2.0], 0), (9009, [], 0)]
    return rows + odd


def brute(rows, least):
    ok = [(i, np.array(v, float), k) for i, v, k in rows if v and k is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    n, links = {i: 0 for i, _, _ in rows}, []
    for x, (i, a, k) in enumerate(ok):
        for j, b, m in ok[x + 1:]:
            if k == m and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                n[i] += 1
                n[j] += 1
                links.append((i, j))
    return n, closure(list(n), links), links


@pytest.mark.parametrize("block", [2048, 16])
def test_all_links_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(embed, "BLOCK", block)
    rows = data()
    n, comp, links = brute(rows, 0.98)
    assert len(links) > 1000
    got = embed.near_duplicates(spark.createDataFrame([(*r, 1, 1, True) for r in rows], SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {i: (n[i], comp[i], comp[i] == i) for i in n}


def test_lower_recall_ends_the_traversal_earlier(spark):
    rows = data()
    n, _, _ = brute(rows, 0.98)
    got = embed.near_duplicates(spark.createDataFrame([(*r, 1, 1, True) for r in rows], SCHEMA), recall=0.95).collect()
    assert embed._reach(0.98, 0.95, 32, 64) < embed._reach(0.98, 1.0, 32, 64)
    assert sum(r["n_links"] for r in got) >= 0.9 * sum(n.values())
    assert all(r["n_links"] <= n[r["vec_id"]] for r in got)


def test_empty_table_and_nothing_usable(spark):
    assert embed.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = [(1, None, 1, 1, 1, True), (2, [0.0, 0.0], 1, 1, 1, True), (None, [1.0, 2.0], 1, 1, 1, True)]
    got = embed.near_duplicates(spark.createDataFrame(odd, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"]) for r in got) == [("1", 0), ("2", 0), ("None", 0)]


def test_every_vector_length_is_compared(spark):
    """More lengths than any list of them may hold."""
    rows = [(2 * d + i, [1.0] * d, 0, 1, 1, True) for d in range(1, 1011) for i in (0, 1)]
    rows += [(5000 + d, [1.0] * (d - 1) + [1.0 + 1e-4], 0, 1, 1, True) for d in (40, 700, 1010)]
    got = {r["vec_id"]: r for r in embed.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows) and all(got[5000 + d]["component_id"] == 2 * d and got[5000 + d]["n_links"] == 2 for d in (40, 700, 1010))
    assert all(got[2 * d + 1]["component_id"] == 2 * d for d in range(1, 1011))


def test_traversal_visits_the_cells_within_reach():
    r = np.random.default_rng(3)
    for reach in (0.0, 0.1, 0.4, 2.0):
        gp, gq = r.uniform(0, 1, (40, 9)), r.uniform(0, 1, (40, 7))
        gp[:, 0] = gq[:, 0] = 0
        want = set(zip(*(a.tolist() for a in np.nonzero(gp[:, :, None] ** 2 + gq[:, None, :] ** 2 <= reach * reach)), strict=True))
        found = list(zip(*(a.tolist() for a in embed._traverse(gp, gq, reach)), strict=True))
        assert len(found) == len(set(found)) and set(found) == want
