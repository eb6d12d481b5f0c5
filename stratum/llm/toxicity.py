"""Toxicity scores from positive and unlabelled text (non-negative PU risk).

Terms are words and their 4- and 5-letter starts.  The terms are chosen by
their document frequencies among the confirmed toxic documents (P) and all
documents (U) of the training fold; a logistic model on their presence is
fitted with numpy, on bounded samples of P and U, under the risk
prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)]).
Labels of 0 serve the prior only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, saved, semi

#: Bounds of the fitting sample (rows) and of the model (terms).
MOST_POSITIVE, MOST_UNLABELLED, MOST_TERMS = 4000, 8000, 1024
#: Terms that a task counts before it hands them on.
TERMS_IN_HAND = 200_000
#: Standard deviations by which P must exceed the clean share of a term.
LEAST_SIGMA = 5.0
#: A document with this score or more is toxic.
THRESHOLD = 0.7

_STRIP = bytes(32 if chr(c) in '.,;:!?"\'()[]{}<>|/\\`*_#~=+-' else c for c in range(256))


class _Terms(dict):
    """The terms of each word met, a word and its starts; ``only`` keeps those
    of a vocabulary.  Forgets all beyond TERMS_IN_HAND words."""

    def __init__(self, only: dict | None = None):
        super().__init__()
        self.only = only

    def __missing__(self, word: bytes) -> tuple[str, ...]:
        parts = word.decode("utf-8", "replace").split()  # other white space than ASCII
        found = tuple(t for w in parts for t in (w, *(f"{w[:n]}~" for n in (4, 5) if len(w) > n)))
        if self.only is not None:
            found = tuple(t for t in found if t in self.only)
        if len(self) > TERMS_IN_HAND:
            self.clear()
        self[word] = found
        return found


def terms(text: str | None, of: _Terms | None = None) -> set[str]:
    """Distinct lower-case words of the whole text and their starts."""
    of = _Terms() if of is None else of
    return set(chain.from_iterable(map(of.__getitem__, set((text or "").lower().encode("utf-8", "replace").translate(_STRIP).split()))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _presence(vocabulary: list[str]):
    """Batch function: (part, text) to (part, bits of the terms present)."""
    at = {t: i for i, t in enumerate(vocabulary)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Terms(at)
        for b in chunks(batches):
            x = np.zeros((b.num_rows, len(at)), bool)
            for i, text in enumerate(b["text"].to_pylist()):
                x[i, [at[t] for t in terms(text, of)]] = True
            yield pa.RecordBatch.from_arrays([b["part"], pa.array([r.tobytes() for r in np.packbits(x, axis=1)], pa.binary())], ["part", "bits"])
    return rows


def _scorer(model: dict):
    """Scores of a column of texts.  Weights are added in sorted order, so a
    text has one score wherever it is computed."""
    weights, bias = model["weights"], model["bias"]
    of = _Terms(weights)

    def scores(texts: pa.Array) -> np.ndarray:
        z = np.array([bias + sum(sorted(weights[t] for t in terms(x, of))) for x in texts.to_pylist()], np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return scores


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, text) to (term, p, u, rows): documents of either part that hold
    a term; the row without a term counts the documents."""
    of, held, n = _Terms(), (Counter(), Counter()), [0, 0]

    def out(p: dict, u: dict) -> pa.RecordBatch:
        both = list(p.keys() | u.keys())
        return pa.RecordBatch.from_arrays([pa.array(both, pa.string()), *(pa.array([c.get(t, 0) for t in both], pa.int64()) for c in (p, u))], ["term", "p", "u"])

    for b in chunks(batches):
        for part, text in zip(b["part"].to_pylist(), b["text"].to_pylist(), strict=True):
            n[1 - part] += 1
            held[1 - part].update(terms(text, of))
        if len(held[0]) + len(held[1]) > TERMS_IN_HAND:
            yield out(*held)
            held = (Counter(), Counter())
    yield out(*held)
    yield out({None: n[0]}, {None: n[1]})


def fit(docs: DataFrame, labels: DataFrame, steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> dict:
    """The model: {"weights": {term: weight}, "bias", "prior"}.

    Only documents and labels of the training fold are read.  Terms are
    counted over all of its documents; the fit takes MOST_POSITIVE confirmed
    and MOST_UNLABELLED other rows, in the order of a hash of id and text (a
    row that repeats both counts once).  A document with several labels counts
    as toxic if one of them says so; null labels say nothing.  Without
    positive documents, or without terms that tell them apart, the model
    scores 0 everywhere."""
    own = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    own = saved(own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    n, positive = own.agg(F.count("*"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    if not positive:
        return {"weights": {}, "bias": -20.0, "prior": 0.0}
    prior = min(0.9, positive / n)
    toxic = own.filter("toxic = 1").select("doc_id")
    train = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    confirmed = semi(train, toxic, "doc_id")

    counts = train.select(F.lit(0).alias("part"), "text").unionByName(confirmed.select(F.lit(1).alias("part"), "text"))
    counts = saved(counts.mapInArrow(_counted, "term string, p bigint, u bigint").groupBy("term").agg(F.sum("p").alias("p"), F.sum("u").alias("u")), "toxic-terms")
    size = counts.filter("term is null").first()
    np_, nu = max(1, size["p"]), max(1, size["u"])
    # expected share among the clean part of U, never below 0; both sides smoothed
    share_p = (F.col("p") + 0.5) / (np_ + 1)
    clean = F.greatest(F.col("u") / nu - prior * F.col("p") / np_, F.lit(0.0))
    share_c = (clean + 0.5 / nu) / (1 - prior)
    gain = share_p * F.log2(share_p / share_c)
    beyond_chance = (F.col("p") - np_ * share_c) / F.sqrt(np_ * share_c * F.greatest(1 - share_c, F.lit(0.0)) + 0.25)
    best = counts.filter(F.col("term").isNotNull() & (beyond_chance >= LEAST_SIGMA)).select("term", gain.alias("g")).orderBy(F.desc("g"), "term").limit(MOST_TERMS)
    vocabulary = [r["term"] for r in best.collect()]
    if not vocabulary:
        return {"weights": {}, "bias": -20.0, "prior": prior}

    at = F.xxhash64("doc_id", "text").alias("at")
    chosen = [of.select(F.lit(part).alias("part"), at).distinct().orderBy("at").limit(most)
              for part, of, most in ((1, confirmed, MOST_POSITIVE), (0, train, MOST_UNLABELLED))]
    keys = saved(chosen[0].union(chosen[1]), "toxic-sample")  # MOST_POSITIVE + MOST_UNLABELLED rows at most
    sample = train.withColumn("at", at).join(F.broadcast(keys), "at").dropDuplicates(["part", "at"]).select("part", "text")
    rows = sample.mapInArrow(_presence(vocabulary), "part int, bits binary").collect()
    x = np.unpackbits(np.vstack([np.frombuffer(r["bits"], np.uint8) for r in rows]), axis=1)[:, : len(vocabulary)].astype(np.float32)
    part = np.array([r["part"] for r in rows])
    w, bias = nnpu(x[part == 1], x[part == 0], prior, steps, rate, decay)
    return {"weights": dict(zip(vocabulary, map(float, w), strict=True)), "bias": float(bias), "prior": prior}


def nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int, rate: float, decay: float) -> tuple[np.ndarray, float]:
    """Logistic weights under the non-negative PU risk, by Adam on the whole
    sample.  Where the estimated negative risk falls below 0, the step raises
    it again instead of lowering it further."""
    w = np.zeros(p.shape[1] + 1, np.float64)
    m, v = np.zeros_like(w), np.zeros_like(w)
    p1, u1 = (np.hstack([a, np.ones((len(a), 1), a.dtype)]) for a in (p, u))
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(a @ w.astype(np.float32), -30, 30))) for a in (p1, u1))
        up = p1.T @ (sp - 1) / max(1, len(p1))                      # of l(+) over P
        down_p = p1.T @ sp / max(1, len(p1))                        # of l(-) over P
        down_u = u1.T @ su / max(1, len(u1))                        # of l(-) over U
        negative = (-np.log1p(-np.minimum(su, 1 - 1e-7))).mean() - prior * (-np.log1p(-np.minimum(sp, 1 - 1e-7))).mean()
        g = prior * up + (down_u - prior * down_p) if negative >= 0 else prior * down_p - down_u
        g = g + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], w[-1]


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Scores read the whole text, of any length, and nothing else: repeated rows
    have equal scores, ids may repeat or be null (then not held out), null and
    empty texts have the score of no terms.  Extra columns aren't read; an
    empty table gives no rows."""
    scores = _scorer(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(scores(b["text"]))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType
    out = docs.select("doc_id", "text").mapInArrow(rows, T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType())]))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (all columns, of any name) without the rows that the model
    rejects, each judged by its own text; null and empty texts have the score
    of no terms.  Rows keep their repeats; an empty table stays empty."""
    scores = _scorer(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            yield b.filter(pa.array(scores(b["text"]) < threshold))

    return docs.mapInArrow(rows, docs.schema)
