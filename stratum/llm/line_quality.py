"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad.  Features of a line and of its neighbours
(counts of characters and words, in bins) weigh for good; transitions couple
neighbouring lines.  Only documents are labelled, so the field is fitted on
what a document's label says about its lines: all lines of a good document are
good, at least one line of a bad one is bad, and more likely all of them.  Forward-backward gives the
marginals of the lines; their mean, weighted by length, is mapped to the
score by a logistic curve fitted on the same sample.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, saved

#: The fitting sample: documents of either label, characters of one of them, lines of one of them.
MOST_DOCUMENTS, MOST_CHARS, MOST_LINES = 4000, 60_000, 256
#: Bins of a feature: quantiles over the sample's lines and over the distinct values found there.
BINS = 16
#: Share of a bad document's label that says that all its lines are bad; the rest says that one is.
ALL_BAD = 0.2
#: A document with this score or more is good.
THRESHOLD = 0.3

_SPACE, _LOWER, _UPPER, _OTHER, _DIGIT, _POINT, _MARK, _SYMBOL = range(8)
KINDS = 8


def _kind(c: int) -> int:
    ch, cat = chr(c), unicodedata.category(chr(c))
    if ch.isspace():
        return _SPACE
    if ch in ".,;:'\"-()":
        return _POINT
    return {"Ll": _LOWER, "Lu": _UPPER, "Lt": _UPPER, "Nd": _DIGIT}.get(cat) or {"L": _OTHER, "M": _OTHER, "N": _DIGIT, "P": _MARK}.get(cat[0], _SYMBOL)


#: Kinds of the characters below U+3000; all beyond are letters without case.
_TABLE = np.array([_kind(c) for c in range(0x3000)] + [_OTHER], np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def line_features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all lines, first line of each text, length of each line).
    Every text has at least one line; null is the empty one.  A text in
    which only \\r divides lines is one line."""
    texts = [t or "" for t in texts]
    joined = "\n".join(texts)
    point = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    kind = _TABLE[np.minimum(point, len(_TABLE) - 1)]
    ends = np.append(np.flatnonzero(point == 10), len(point))
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    of = np.repeat(np.arange(len(ends)), np.diff(np.append(starts, len(point) + 1)))[: len(point)]
    counts = np.bincount(of * KINDS + kind, minlength=len(ends) * KINDS).reshape(-1, KINDS).astype(np.float64)
    counts[:-1, _SPACE] -= 1  # the line break
    solid = kind != _SPACE
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    n = len(ends)
    words = np.bincount(of[solid & ~before], minlength=n)
    closed = np.bincount(of[solid & ~after & (kind >= _MARK)], minlength=n)  # words that end in a mark or symbol
    single = np.bincount(of[solid & ~after & ~before & (kind >= _MARK)], minlength=n)
    distinct, again = np.zeros(n), np.zeros(n)
    for i, line in enumerate(joined.split("\n")):
        w = line.split()
        distinct[i] = len(set(w))
        again[i] = sum(map(str.__eq__, w, w[1:]))
    chars = np.maximum(1, length - counts[:, _SPACE])
    letters = np.maximum(1, counts[:, [_LOWER, _UPPER, _OTHER]].sum(axis=1))
    some = np.maximum(1, words)
    first = np.cumsum([0] + [t.count("\n") + 1 for t in texts])[:-1]
    features = np.stack([
        np.log1p(length), np.log1p(words), chars / some, counts[:, _UPPER] / letters, counts[:, _DIGIT] / chars, counts[:, _POINT] / chars,
        counts[:, _MARK] / chars, counts[:, _SYMBOL] / chars, closed / some, single / some, distinct / some, again / some,
    ], axis=1)
    return features, first, length


def _binned(features: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, features[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int16)


def _edges(values: np.ndarray) -> np.ndarray:
    half = BINS // 2
    at = np.arange(1, half) / half
    return np.unique(np.concatenate([np.quantile(values, at), np.quantile(np.unique(values), at)]))


class Model(NamedTuple):
    edges: list             # of the bins, by feature
    own: np.ndarray         # weights for good, feature x bin
    above: np.ndarray       # of the line before
    below: np.ndarray       # of the line after
    bias: float
    start: float            # the first line is good
    change: np.ndarray      # (good after bad, bad after good, good after good), bad after bad is 0
    curve: tuple            # score = logistic(a + b * mean marginal)


def _layout(first: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    last = np.append(first[1:], lines) - 1
    has_above, has_below = np.ones(lines, bool), np.ones(lines, bool)
    has_above[first] = False
    has_below[last] = False
    return has_above, has_below


def _unary(model: Model, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log-odds for good of every line, without transitions."""
    every = np.arange(bins.shape[1])
    has_above, has_below = _layout(first, len(bins))
    u = model.bias + model.own[every, bins].sum(axis=1)
    up, down = model.above[every, bins].sum(axis=1), model.below[every, bins].sum(axis=1)
    u[has_above] += up[np.flatnonzero(has_above) - 1]
    u[has_below] += down[np.flatnonzero(has_below) + 1]
    u[first] += model.start
    return u


class Chains(NamedTuple):
    good: np.ndarray        # marginal P(good) of every line
    pairs: np.ndarray       # line x 3: P of (bad, good), (good, bad), (good, good) with the line before; 0 for first lines
    all_good: np.ndarray    # log P(all lines good) of every text
    all_bad: np.ndarray     # log P(all lines bad)


def forward_backward(u: np.ndarray, change: np.ndarray, first: np.ndarray) -> Chains:
    """Marginals of all chains: one step for the t-th line of every text that
    has one, the texts in the order of falling length."""
    n = len(u)
    size = np.diff(np.append(first, n))
    order = np.argsort(-size, kind="stable")
    start, size = first[order], size[order]
    turns = int(size[0]) if len(size) else 0
    bg, gb, gg = change
    alpha = np.zeros((n, 2))  # log weights (bad, good) of the lines up to here
    beta = np.zeros((n, 2))
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(turns)]  # texts with more than t lines
    if turns:
        alpha[start, 1] = u[start]
    for t in range(1, turns):
        at = start[: active[t]] + t
        b, g = alpha[at - 1, 0], alpha[at - 1, 1]
        alpha[at, 0] = np.logaddexp(b, g + gb)
        alpha[at, 1] = np.logaddexp(b + bg, g + gg) + u[at]
    for t in range(turns - 2, -1, -1):
        at = start[: active[t + 1]] + t
        b, g = beta[at + 1, 0], beta[at + 1, 1] + u[at + 1]
        beta[at, 0] = np.logaddexp(b, g + bg)
        beta[at, 1] = np.logaddexp(b + gb, g + gg)
    last = np.append(first[1:], n) - 1
    z = np.logaddexp(alpha[last, 0], alpha[last, 1])
    text = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    total = z[text]
    good = np.exp(alpha[:, 1] + beta[:, 1] - total)
    pairs = np.zeros((n, 3))
    inner = np.ones(n, bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    into_good = u[at] + beta[at, 1] - total[at]
    pairs[at, 0] = np.exp(alpha[at - 1, 0] + bg + into_good)
    pairs[at, 1] = np.exp(alpha[at - 1, 1] + gb + beta[at, 0] - total[at])
    pairs[at, 2] = np.exp(alpha[at - 1, 1] + gg + into_good)
    lines = np.diff(np.append(first, n))
    all_good = np.add.reduceat(u, first) + (lines - 1) * gg - z if n else np.zeros(0)
    return Chains(good, pairs, np.minimum(all_good, 0.0), np.minimum(-z, 0.0))


def _gradient(model: Model, bins: np.ndarray, first: np.ndarray, label: np.ndarray, share: np.ndarray) -> tuple[float, list]:
    """Loss and gradient of the documents' labels.  ``share``: the weight of
    each document."""
    u = _unary(model, bins, first)
    c = forward_backward(u, model.change, first)
    n = len(bins)
    text = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    log_p = c.all_good
    p = np.exp(log_p)
    rest = np.maximum(-np.expm1(np.minimum(log_p, -1e-9)), 1e-9)  # P(some line is bad)
    loss = -(share * np.where(label == 1, log_p, (1 - ALL_BAD) * np.log(rest) + ALL_BAD * c.all_bad)).sum()
    # E[f | label] - E[f] = toward * (f(all lines good) - E[f]) + off * (f(all lines bad) - E[f]); f is 0 where all lines are bad
    toward = (share * np.where(label == 1, 1.0, -(1 - ALL_BAD) * p / rest))[text]
    off = (share * np.where(label == 1, 0.0, ALL_BAD))[text]
    node = off * c.good - toward * (1 - c.good)
    has_above, has_below = _layout(first, n)
    pair = off[:, None] * c.pairs - toward[:, None] * (np.array([0.0, 0.0, 1.0]) - c.pairs)
    pair[~has_above] = 0
    features = bins.shape[1]
    flat = bins + np.arange(features) * BINS

    def grad(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(flat[rows].ravel(), np.repeat(x, features), minlength=features * BINS).reshape(features, BINS)

    above, below = np.flatnonzero(has_above), np.flatnonzero(has_below)
    return loss, [grad(node, np.arange(n)), grad(node[above], above - 1), grad(node[below], below + 1), np.array(node.sum()), np.array(node[first].sum()), pair.sum(axis=0)]


def fit_lines(features: np.ndarray, first: np.ndarray, length: np.ndarray, label: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """The field, by Adam on the whole sample; both labels have the same weight."""
    edges = [_edges(features[:, j]) for j in range(features.shape[1])]
    bins = _binned(features, edges)
    shape = (features.shape[1], BINS)
    share = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    w = [np.zeros(shape), np.zeros(shape), np.zeros(shape), np.array(1.0), np.array(0.0), np.zeros(3)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for t in range(1, steps + 1):
        _, g = _gradient(Model(edges, *w, (0, 0)), bins, first, label, share)
        for j, x in enumerate(w):
            step = g[j] + decay * x
            m[j], v[j] = 0.9 * m[j] + 0.1 * step, 0.999 * v[j] + 0.001 * step * step
            w[j] = x - rate * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    model = Model(edges, *w, (0, 0))
    return model._replace(curve=_curve(_means(model, bins, first, length), label, share))


def _means(model: Model, bins: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Mean marginal of the lines of each text, weighted by their length plus 1."""
    good = forward_backward(_unary(model, bins, first), model.change, first).good
    size = length + 1.0
    return np.add.reduceat(good * size, first) / np.add.reduceat(size, first) if len(first) else np.zeros(0)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _curve(mean: np.ndarray, label: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """a, b of the logistic curve from mean marginals to labels (Newton steps
    with a small decay; b isn't negative)."""
    x = np.stack([np.ones_like(mean), mean], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = _logistic(x @ w)
        g = x.T @ (share * (p - label)) + 1e-3 * w
        h = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, g)
    return (float(w[0]), float(w[1])) if w[1] > 0 else (float(np.log((share @ label + 1e-9) / (share @ (1 - label) + 1e-9))), 0.0)


def scores(model: Model | None, texts: list) -> np.ndarray:
    """Scores of texts; they depend on the text alone."""
    if model is None:
        return np.ones(len(texts))
    if not texts:
        return np.zeros(0)
    features, first, length = line_features(texts)
    return _logistic(model.curve[0] + model.curve[1] * _means(model, _binned(features, model.edges), first, length))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model from documents and labels of the training fold, or None where
    one of the two labels is missing there (then every score is 1).

    The sample has at most MOST_DOCUMENTS documents of each label, in the
    order of a hash of the id and the text, among those of at most MOST_CHARS
    characters and MOST_LINES lines.  A document with several labels is good
    only if all say so; null labels and ids say nothing."""
    own = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    own = saved(own.groupBy("doc_id").agg(F.min("quality").alias("quality")), "quality-labels")
    able = docs.select("doc_id", "text").filter((F.length("text") <= MOST_CHARS) & (F.length("text") - F.length(F.replace("text", F.lit("\n"))) < MOST_LINES))
    known = able.select("doc_id", F.xxhash64("doc_id", "text").alias("at")).join(own, "doc_id")
    kept = [known.filter(F.col("quality") == q).select("at", "quality").distinct().orderBy("at").limit(MOST_DOCUMENTS) for q in (0, 1)]
    chosen = saved(kept[0].union(kept[1]), "quality-chosen")
    rows = (able.withColumn("at", F.xxhash64("doc_id", "text")).join(F.broadcast(chosen), "at").select("at", "quality", "text")
            .dropDuplicates(["at"]).mapInArrow(_sampled, "at bigint, quality int, lines int, features binary, length binary").orderBy("at").collect())
    label = np.array([r["quality"] for r in rows])
    if len(set(label.tolist())) < 2:
        return None
    features = np.concatenate([np.frombuffer(r["features"], np.float64) for r in rows]).reshape(sum(r["lines"] for r in rows), -1)
    length = np.concatenate([np.frombuffer(r["length"], np.int64) for r in rows])
    first = np.cumsum([0] + [r["lines"] for r in rows])[:-1]
    return fit_lines(features, first, length, label)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        if not b.num_rows:
            continue
        features, first, length = line_features(b["text"].to_pylist())
        ends = np.append(first[1:], len(length))
        part = list(zip(first.tolist(), ends.tolist(), strict=True))
        yield pa.RecordBatch.from_arrays(
            [b["at"], b["quality"], pa.array([e - s for s, e in part], pa.int32()), pa.array([features[s:e].tobytes() for s, e in part], pa.binary()),
             pa.array([length[s:e].astype(np.int64).tobytes() for s, e in part], pa.binary())], ["at", "quality", "lines", "features", "length"])


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Scores read the whole text and nothing else: repeated rows have equal
    scores.  Null and empty texts are one empty line.  held_out: crc32(doc_id
    as text) mod 5 is 0, false for null ids.  Long texts are one chain; a
    batch of 64 texts is in memory, with about 20 bytes a character and 300 a
    line.  Extra columns aren't read; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 64):
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(scores(model, b["text"].to_pylist()), pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(rows, T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType())]))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
