"""Embedding near-duplicates by an inverted multi-index.

Independent codebooks on the two halves of the unit vectors make a product
grid of cells.  Every vector is filed in one cell and visits cells in order of
the least distance at which a vector in them can lie (per half: the distance
to the bisecting plane between the nearest centre and the cell's).  Visits end
at the distance that belongs to the target recall; at 1.0 that is the link
distance itself, so no link is lost.  Every met pair is verified by its cosine
in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, saved

#: Vectors that fit the codebooks, at most; centres per half, at least and at most.
FIT_SAMPLE, LEAST_CENTRES, MOST_CENTRES = 10_000, 8, 512
#: Vectors a cell holds on average; a cell with more than BLOCK is split.
PER_CELL, BLOCK = 256, 2048


def _usable(rows: DataFrame) -> DataFrame:
    """One row per distinct (label, vector) that can link: its smallest id, how
    many rows have it, and the vector as doubles."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    own = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
    own = own.filter(finite & F.exists(x, lambda v: v != 0))
    return own.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))


def _centres(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from k-means++-like seeds in hash order; empty centres stay."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return c


def _gaps(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and for every centre a lower bound of the
    distance from the row to any point that is filed there."""
    d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)
    near = d.argmin(1)
    apart = np.sqrt(np.maximum(((c[:, None, :] - c[None, :, :]) ** 2).sum(2), 0))[near]
    with np.errstate(divide="ignore", invalid="ignore"):
        gap = np.where(apart > 0, (d - d[np.arange(len(x)), near][:, None]) / (2 * apart), 0)
    return near, np.maximum(gap, 0)


def _traverse(gp: np.ndarray, gq: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, i, j) of the cells within ``reach`` of each row, by multi-sequence
    traversal: both gap lists are sorted; every centre of the first list that
    is near enough opens with the nearest centre of the second, and goes on
    through the second list until their sum is out of reach.  The work is that
    of the cells found, not that of the grid."""
    n, k = gq.shape
    order_p, order_q = np.argsort(gp, axis=1, kind="stable"), np.argsort(gq, axis=1, kind="stable")
    sq_p = np.take_along_axis(gp, order_p, 1) ** 2
    sq_q = np.minimum(np.take_along_axis(gq, order_q, 1) ** 2, 8.0)  # unit vectors are less than 8 apart, squared
    row, at = np.nonzero(sq_p <= reach * reach)
    left = reach * reach - sq_p[row, at]
    # one sorted list of all rows, 16 apart, so that one search ends every sequence
    flat = (sq_q + 16.0 * np.arange(n)[:, None]).ravel()
    count = np.searchsorted(flat, left + 16.0 * row + 1e-9 * (1 + row), side="right") - row * k
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    rows = np.repeat(row, count)
    return rows, np.repeat(order_p[row, at], count), order_q[rows, step]


def _unit(rows: list, width: int) -> np.ndarray:
    """Rows as unit vectors, filled up with zeros to ``width``; scaled first, so
    no norm over- or underflows."""
    m = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        m[i, : len(row)] = row
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def near_duplicates(rows: DataFrame, least: float = 0.98, recall: float = 1.0) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``rows``.

    Rows link when labels are equal and the cosine is ``least`` or more.
    Vectors (or labels or ids) that are null, and vectors that are zero, empty
    or hold null or non-finite components link with nothing.  Vectors of
    different lengths don't link.  Equal vectors of a label are compared once
    and count as often as they occur.  Rows that share a vec_id stay rows of
    their own and are one vertex of the link graph.  Other columns aren't
    read.
    """
    distinct = saved(_usable(rows).withColumn("dims", F.size("embedding")), "vectors")
    width = distinct.agg(F.max("dims")).first()[0]
    member = rows.select("vec_id", "label", "embedding")
    if width is None:
        found = member.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    else:
        met = saved(_met(distinct, width, least, recall), "vector-links")
        totals = met.filter("a is null").groupBy("rep", "label", "dims").agg(F.sum("n").alias("n"))
        known = distinct.join(totals, ["rep", "label", "dims"], "left")
        comp = components(met.filter("a is not null").select("a", "b").distinct(), "vector-components")
        known = known.join(comp, known["rep"] == comp["v"], "left").select(
            F.col("label").alias("_l"), F.col("embedding").alias("_e"), F.coalesce("c", "rep").alias("_c"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("_n"))
        found = member.join(known, (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e")) & F.col("vec_id").isNotNull(), "left").select(
            "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_c", "vec_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _met(distinct: DataFrame, dims: int, least: float, recall: float) -> DataFrame:
    """Rows (rep, label, dims, n) with linked weights found in one cell, and
    rows (a, b) with a spanning forest of the links found in one cell.  Shorter
    vectors are filed as if filled up to ``dims``; the length is part of the
    cell's key, so vectors of different lengths don't meet."""
    spark = distinct.sparkSession
    n, n_labels = distinct.agg(F.count("*"), F.countDistinct("label")).first()
    k = int(min(MOST_CENTRES, max(LEAST_CENTRES, np.ceil(np.sqrt(n / (PER_CELL * n_labels))))))
    sample = distinct.orderBy(F.xxhash64("rep"), "rep", "label").limit(FIT_SAMPLE).select("embedding").collect()
    fit = _unit([r[0] for r in sample], dims)
    half = max(1, dims // 2)
    books = [_centres(fit[:, :half], k), _centres(fit[:, half:], k) if dims > half else np.zeros((1, 0))]
    books = spark.sparkContext.broadcast(books)  # 2 * MOST_CENTRES centres at most
    reach = _reach(least, recall, half, k)
    fields = {f.name: f for f in distinct.schema}
    plain = [fields[c] for c in ("rep", "label", "dims", "weight", "embedding")]

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once for its home cell and once per earlier cell that it
        visits: of two cells, one side's visits do.  Chunks bound the grid of gaps."""
        first, second = books.value
        chunk = max(1, 4_000_000 // (len(first) ** 2 + len(second) ** 2 + dims))
        for b in (whole.slice(s, chunk) for whole in batches for s in range(0, whole.num_rows, chunk)):
            x = _unit(b["embedding"].to_pylist(), dims)
            (p, gp), (q, gq) = _gaps(x[:, :half], first), _gaps(x[:, half:], second)
            own = p * len(second) + q
            row, i, j = _traverse(gp, gq, reach)
            cell = i * len(second) + j
            use = cell < own[row]
            row, cell = np.concatenate([np.arange(len(x)), row[use]]), np.concatenate([own, cell[use]])
            home = np.arange(len(row)) < len(x)
            kept = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(cell.astype(np.int32)), pa.array(home)], [*kept.schema.names, "cell", "home"])

    schema = T.StructType([*plain, T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType())])
    filed = saved(distinct.select(*[f.name for f in plain]).mapInArrow(visits, schema), "vector-visits")

    # residents of a cell are split into blocks, and so are those who meet them: a task has 2 * BLOCK vectors or so
    sizes = filed.groupBy("label", "dims", "cell").agg(F.ceil(F.count_if("home") / BLOCK).cast("int").alias("blocks"),
                                               F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).filter("blocks > 0")
    cells = filed.join(sizes, ["label", "dims", "cell"])
    block, part = (F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(c)).cast("int") for salt, c in enumerate(("blocks", "parts")))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    residents = cells.filter("home").withColumn("block", block).withColumn("part", every("parts")).withColumn("resident", F.lit(True))
    visitors = cells.withColumn("block", every("blocks")).withColumn("part", part).withColumn("resident", F.lit(False))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        size = int(pdf["dims"].iloc[0])
        vec = _unit(pdf["embedding"].tolist(), size)
        rep, weight, home = pdf["rep"].to_numpy(), pdf["weight"].to_numpy(), pdf["home"].to_numpy()
        resident = pdf["resident"].to_numpy()
        r, v = np.flatnonzero(resident), np.flatnonzero(~resident)
        n, edge = np.zeros(len(pdf), np.int64), []
        for s in range(0, len(v), 512):
            w = v[s: s + 512]
            link = (vec[w] @ vec[r].T >= least) & (rep[w][:, None] != rep[r][None, :])
            n[w] += link @ weight[r]
            n[r] += (link & ~home[w][:, None]).T @ weight[w]  # at home, the resident has its own visit
            i, j = np.nonzero(link)
            edge += _forest(rep[w[i]], rep[r[j]])
        some = n > 0
        counted = pd.DataFrame({"rep": rep[some], "label": pdf["label"].to_numpy()[some], "dims": size, "n": n[some]})
        edge = np.array(_forest(*np.array(edge).T), dtype=rep.dtype) if edge else np.zeros((0, 2), rep.dtype)
        tied = pd.DataFrame({"a": edge[:, 0], "b": edge[:, 1]})
        return pd.concat([counted, tied]).reindex(columns=["rep", "label", "dims", "n", "a", "b"]).astype(object).where(lambda d: d.notna(), None)

    out = T.StructType([T.StructField("rep", plain[0].dataType), T.StructField("label", plain[1].dataType), T.StructField("dims", T.IntegerType()), T.StructField("n", T.LongType()),
                        T.StructField("a", plain[0].dataType), T.StructField("b", plain[0].dataType)])
    return residents.unionByName(visitors).groupBy("label", "dims", "cell", "block", "part").applyInPandas(verify, out)


def _reach(least: float, recall: float, half: int, centres: int) -> float:
    """Up to which distance cells are visited.  Vectors linked by a cosine of
    ``least`` are sqrt(2 - 2 * least) apart, which is the reach at recall 1.
    Below it the reach is the part of that distance along one direction of
    ``half`` dimensions that is exceeded with a chance of 1 - recall at any of
    the bisecting planes."""
    apart = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-7
    if recall >= 1:
        return float(apart)
    missed = (1 - recall) / centres
    return float(apart * min(1.0, NormalDist().inv_cdf(1 - missed / 2) / np.sqrt(half)))


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (a, b)."""
    root: dict[int, int] = {}

    def top(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out
