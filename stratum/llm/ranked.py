"""Ranked lexical search with hashed max-sketches.

Every document folds the impacts of its terms into a sketch: the maximum of
the impacts by hash bucket.  The query terms' weights times the sketch values
of their buckets, looked up for a batch of documents at once, bound the scores
from above.  Documents are rescored exactly in the order of descending bounds
until the bound falls below the lowest score of the best ones found so far.
Each task keeps the best of its own documents; the best of all tasks are
ranked by a window.  Queries are taken in blocks of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, saved

#: Buckets of a sketch.
BUCKETS = 8192
#: Bytes of query text in one block, as a mean; a longer query is alone or with a few others.
BLOCK_BYTES = 1 << 20
#: Documents that share one lookup, and how many are rescored at once.
BATCH, STEP = 512, 16
#: Impacts are counted in these units; a document's length counts by LENGTH_PERCENT.
SCALE, LENGTH_PERCENT = 1_000_000_000, 75

# Terms are runs of ASCII letters, digits and all other characters beyond ASCII; A-Z are lower-cased.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of the whole text in their order, in UTF-8."""
    return text.encode("utf-8", "replace").translate(_TERM).split() if text else []


class Corpus(NamedTuple):
    """documents: those with a term; length: all their terms; df: by term."""
    documents: int
    length: int
    df: dict[bytes, int]


def weight(corpus: Corpus, term: bytes) -> int:
    return math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * corpus.df[term] + 1)))


def statistics(docs: DataFrame, vocabulary: set[bytes]) -> Corpus:
    """Counts over all documents; each task sends one row per query term that
    it has met."""
    spread = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, df, n, length = spread.value, {}, 0, 0
        for b in chunks(batches):
            for text in b["text"].to_pylist():
                found = terms(text)
                n += bool(found)
                length += len(found)
                for t in wanted.intersection(found):
                    df[t] = df.get(t, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([*df, None, None], pa.binary()), pa.array([0] * len(df) + [1, 2], pa.int32()),
                                          pa.array([*df.values(), n, length], pa.int64())], ["term", "kind", "n"])

    counted = docs.select("text").mapInArrow(rows, "term binary, kind int, n bigint").groupBy("kind", "term").agg(F.sum("n").alias("n")).collect()
    by = {r["kind"]: r["n"] for r in counted if r["kind"]}
    return Corpus(by.get(1, 0), by.get(2, 0), {bytes(r["term"]): r["n"] for r in counted if not r["kind"]})


class _Query(NamedTuple):
    at: int                 # number of the query row
    words: list[bytes]      # distinct terms that some document holds
    weights: np.ndarray     # times their repeats
    buckets: np.ndarray


def _bucket(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % BUCKETS


def _query(at: int, text: str | None, corpus: Corpus) -> _Query:
    often: dict[bytes, int] = {}
    for t in terms(text):
        if t in corpus.df:
            often[t] = often.get(t, 0) + 1
    return _Query(at, list(often), np.array([weight(corpus, t) * c for t, c in often.items()], np.int64), np.array([_bucket(t) for t in often], np.int64))


class _Batch:
    """Impacts of the terms of some documents, and their sketches."""

    def __init__(self, texts: list, corpus: Corpus):
        self.numbers: dict[bytes, int] = {}
        number = self.numbers.setdefault
        held = [terms(t) for t in texts]
        size = np.array([len(w) for w in held], np.int64)
        flat = np.fromiter((number(t, len(self.numbers)) for w in held for t in w), np.int64, int(size.sum()))
        self.width = max(1, len(self.numbers))
        self.keys, tf = np.unique(np.repeat(np.arange(len(held)), size) * self.width + flat, return_counts=True)
        doc, term = np.divmod(self.keys, self.width)
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * size * corpus.documents) // max(1, corpus.length)
        self.impacts = (SCALE * tf) // (1000 * tf + 8 * m[doc])
        bucket = np.fromiter(map(_bucket, self.numbers), np.int64, len(self.numbers))
        self.sketches = np.zeros((BUCKETS, len(held)), np.int32)
        np.maximum.at(self.sketches, (bucket[term], doc), self.impacts.astype(np.int32))

    def bounds(self, q: _Query) -> np.ndarray:
        return q.weights @ self.sketches[q.buckets]

    def scores(self, q: _Query, docs: np.ndarray) -> np.ndarray:
        """Exact scores of the chosen documents."""
        known = np.array([self.numbers.get(t, -1) for t in q.words], np.int64)
        here = known >= 0
        want = docs[:, None] * self.width + known[here]
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.impacts[at], 0) @ q.weights[here] if here.any() else np.zeros(len(docs), np.int64)


class _Best:
    """The ``top`` best (score, smaller id first) documents of one query.  Rows
    without an id come last among equals."""

    def __init__(self, top: int):
        self.top, self.heap, self.turn = top, [], 0

    def floor(self) -> int:
        """A lower score can't come in."""
        return self.heap[0][0] if len(self.heap) == self.top else 1

    def add(self, score: int, doc_id) -> None:
        self.turn += 1
        entry = (score, _Descending(doc_id), -self.turn, doc_id)
        if len(self.heap) < self.top:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


class _Descending:
    """Orders ids the other way round, null lowest."""
    __slots__ = ("of",)

    def __init__(self, of):
        self.of = of

    def __eq__(self, other):
        return self.of == other.of

    def __lt__(self, other):
        return other.of is not None and (self.of is None or other.of < self.of)


def offer(batch: _Batch, q: _Query, doc_ids: list, best: _Best) -> int:
    """Rescores documents by descending bound while they can come in; returns
    how many were rescored."""
    bounds = batch.bounds(q)
    able = np.flatnonzero(bounds >= best.floor())
    able = able[np.argsort(-bounds[able], kind="stable")]
    done = 0
    for begin in range(0, len(able), STEP):
        part = able[begin: begin + STEP]
        part = part[bounds[part] >= best.floor()]
        if not len(part):
            break
        done += len(part)
        scores = batch.scores(q, part)
        for at in np.flatnonzero(scores >= best.floor()):
            best.add(int(scores[at]), doc_ids[part[at]])
    return done


def _best_of_block(docs: DataFrame, rows: list[Row], top: int) -> DataFrame:
    """(query, doc_id, score, rescored): the best of every task.  ``rows``: (row, text)."""
    vocabulary = {t for r in rows for t in terms(r["text"])}
    corpus = statistics(docs, vocabulary)
    queries = [q for q in (_query(r["row"], r["text"], corpus) for r in rows) if q.words]
    spread = docs.sparkSession.sparkContext.broadcast((corpus._replace(df={}), queries))
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, mine = spread.value
        best = [_Best(top) for _ in mine]
        id_type = None
        for b in chunks(batches, BATCH):
            id_type = b["doc_id"].type
            ids = b["doc_id"].to_pylist()
            batch = _Batch(b["text"].to_pylist(), counts)
            for q, own in zip(mine, best, strict=True):
                offer(batch, q, ids, own)
        found = [(q.at, doc_id, score) for q, own in zip(mine, best, strict=True) for score, _, _, doc_id in own.heap]
        if found:
            row, doc_id, score = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(doc_id, id_type), pa.array(score, pa.int64())], names=[f.name for f in schema])

    return docs.select("doc_id", "text").mapInArrow(ranked, schema)


def search(docs: DataFrame, queries: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of every row of
    ``queries`` (item_id, text) with a score above 0.

    Scores are exact integers over the whole texts of all documents.  Equal
    scores go by ascending doc_id, null ids last; rows that repeat a doc_id
    are documents of their own (equal ones follow each other).  Null, empty
    and term-free texts score nothing and, as queries, return no rows; neither
    do queries of which no document holds a term.  A repeated query row is
    answered for each row.  Very long texts are one document with their whole
    term counts; ``BATCH`` texts are in memory at once.  Extra columns aren't
    read; an empty table on either side gives no rows.

    Queries are read in blocks of about ``block_bytes``; each block makes two
    passes over the documents (statistics, search) and sends at most ``top``
    rows per query and task.
    """
    numbered = saved(queries.select("item_id", "text").withColumn("row", F.monotonically_increasing_id()), "ranked-queries")
    total = numbered.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    best = None
    for block in range(blocks):
        rows = numbered.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "text").collect()
        part = _best_of_block(docs, rows, top)
        best = part if best is None else best.union(part)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    items = numbered.select("row", "item_id")
    return ranked.join(items, "row").select("item_id", "rank", "doc_id", "score")
