"""Periodic runs of words, by the branching-tandem test on suffix arrays.

Documents of a batch are one sequence of word numbers, each closed by a number
of its own, so nothing repeats across documents.  Its suffix array comes from
prefix doubling, the LCP array from the ranks of the doubling rounds.  Every
place k of the LCP array stands for the two sides of its interval that meet
there; the suffixes i of the smaller side look up ISA[i + depth] and
ISA[i - depth] and find a branching tandem (a square that can't be rotated to
the right) where the partner lies on the other side.  No tree is built.  Each
such square is rotated to the left as far as its period lasts; squares that
fill the same stretch are one run, the shortest period its period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import chunks

#: A run has at least so many words, and at least two periods.
LEAST_WORDS = 12
#: Words that are put into one suffix array (a longer document is alone).
BATCH_WORDS = 1 << 16


def suffix_array(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(SA, ISA, ranks by the first 1, 2, 4, ... words) of numbers >= 0."""
    n = len(x)
    _, rank = np.unique(x, return_inverse=True)
    levels, width = [rank.astype(np.int32)], 1
    while True:
        key = levels[-1].astype(np.int64) * (n + 1)
        key[: n - width] += levels[-1][width:] + 1
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.empty(n, np.int32)
        new[order] = np.concatenate([np.zeros(1, np.int32), np.cumsum(sorted_key[1:] != sorted_key[:-1], dtype=np.int32)])
        if new[order[-1]] == n - 1:
            return order, new, levels
        levels.append(new)
        width *= 2


def lcp_array(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at places k - 1 and k of SA have in common."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    for bit in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        rank = levels[bit]
        same = inside[rank[a[inside]] == rank[b[inside]]]
        a[same] += 1 << bit
        b[same] += 1 << bit
    return np.concatenate([np.zeros(1, np.int64), a - order[:-1]])


def _nearest_below(v: np.ndarray, strict: bool) -> np.ndarray:
    """For every place the nearest one to its left with a smaller value (or,
    not strict, an equal one), -1 if there is none; pointers jump over what is
    known already."""
    at = np.arange(-1, len(v) - 1)
    todo = np.flatnonzero(at >= 0)
    while len(todo):
        seen = v[at[todo]]
        todo = todo[seen >= v[todo] if strict else seen > v[todo]]
        at[todo] = at[at[todo]]
        todo = todo[at[todo] >= 0]
    return at


def branching_squares(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, d) of all squares x[i:i+d] == x[i+d:i+2d] whose next word differs
    from x[i+d]."""
    order, place, levels = suffix_array(x)
    lcp = lcp_array(order, levels)
    del levels
    n = len(x)
    left = _nearest_below(lcp, strict=True)
    right = n - 1 - _nearest_below(lcp[::-1], strict=False)[::-1]
    k = np.flatnonzero(lcp > 0)
    depth, low, high = lcp[k], np.maximum(left[k], 0), right[k]  # places low .. k-1 and k .. high-1
    first = k - low <= high - k
    begin, size = np.where(first, low, k), np.where(first, k - low, high - k)
    found_i, found_d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cuts = np.searchsorted(np.cumsum(size), np.arange(1, size.sum() // (1 << 18) + 1) << 18) + 1
    for part in np.split(np.arange(len(k)), np.unique(cuts[cuts < len(k)])):
        reps = size[part]
        node = np.repeat(part, reps)
        offset = np.arange(len(node)) - np.repeat(np.cumsum(reps) - reps, reps)
        i = order[begin[node] + offset]
        d = depth[node]
        lo, hi = np.where(first[node], k[node], low[node]), np.where(first[node], high[node], k[node])  # the other side
        for sign in (1, -1):
            j = i + sign * d
            inside = np.flatnonzero((j >= 0) & (j < n))
            p = place[j[inside]]
            hit = inside[(p >= lo[inside]) & (p < hi[inside])]
            found_i.append(np.minimum(i[hit], j[hit]))
            found_d.append(d[hit])
    return np.concatenate(found_i), np.concatenate(found_d)


def _rotated(x: np.ndarray, i: int, d: int) -> int:
    """The smallest start from which x keeps the period d up to i."""
    step = 64
    while i > 0:
        low = max(0, i - step)
        differs = np.flatnonzero(x[low:i] != x[low + d: i + d])
        if len(differs):
            return low + int(differs[-1]) + 1
        i, step = low, step * 2
    return i


def runs(x: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted by start, then period."""
    if len(x) < 2:
        return []
    i, d = branching_squares(x)
    # short periods need more than a square: look at the words before it first
    alive = i + 2 * d >= least
    for p in range(1, (least + 1) // 2):
        mine = np.flatnonzero(alive & (d == p))
        for back in range(1, least - 2 * p + 1):
            at = i[mine] - back
            ok = (at >= 0) & (x[at] == x[at + p])
            alive[mine[~ok]] = False
            mine = mine[ok]
    i, d = i[alive], d[alive]
    out: list[tuple[int, int, int]] = []
    by = np.lexsort((d, i + 2 * d))  # by end, then period
    last, here = -1, []
    for a, p in zip(i[by].tolist(), d[by].tolist(), strict=True):
        end = a + 2 * p
        if end != last:
            last, here = end, []
        # the same stretch as a run found before, with several of its periods as one
        if any(p % q == 0 and a >= s for s, q in here):
            continue
        s = _rotated(x, a, p)
        here.append((s, p))
        out.append((s, end - s, p))
    return sorted((s, n, p) for s, n, p in out if n >= max(least, 2 * p))


def repeated_tail(n: int, doc_id) -> tuple[int, int] | None:
    """(first word, period) of the tail that every tenth document repeats; None
    for others, without words or without an id."""
    if doc_id is None or not n:
        return None
    g, r = divmod(zlib.crc32(str(doc_id).encode()), 10)
    a = g % n
    return None if r else (a, 1 + (n - a) // (3 + g % 8))


def _digest(parts: list[bytes], by: bytes = b"") -> str:
    return hashlib.sha256(by.join(parts)).hexdigest()


def _report(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = np.zeros(len(words) + 1, np.int64)
    for s, n, p in found:
        gone[s + p] += 1
        gone[s + n] -= 1
    kept = words if not found else [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
    line = "".join(f"{s},{n},{p}\n" for s, n, p in found).encode()
    values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *values, _digest([line]), _digest(kept, b" "))


def _documents(doc_ids: list, texts: list) -> Iterator[tuple]:
    """Report of every document; documents share a suffix array until it has
    BATCH_WORDS words."""
    held: list[list[bytes]] = []
    size = 0
    numbers: dict[bytes, int] = {}
    sequences: list[list[int]] = []

    def done() -> Iterator[tuple]:
        closed = [np.array([*s, len(numbers) + at], np.int64) for at, s in enumerate(sequences)]
        starts = np.cumsum([0, *map(len, closed)])
        found = runs(np.concatenate(closed))
        at = np.searchsorted(starts, [s for s, _, _ in found], side="right") - 1
        each: list[list] = [[] for _ in held]
        for doc, (s, n, p) in zip(at.tolist(), found, strict=True):
            each[doc].append((s - int(starts[doc]), n, p))
        for words, mine in zip(held, each, strict=True):
            yield _report(words, mine)

    for doc_id, text in zip(doc_ids, texts, strict=True):
        words = text.encode("utf-8", "replace").split() if text else []
        if tail := repeated_tail(len(words), doc_id):
            a, p = tail
            part = words[a: a + p]
            words = words[:a] + (part * ((len(words) - a) // p + 1))[: len(words) - a]
        if held and size + len(words) > BATCH_WORDS:
            yield from done()
            held, sequences, numbers, size = [], [], {}, 0
        held.append(words)
        sequences.append([numbers.setdefault(w, len(numbers)) for w in words])
        size += len(words) + 1
    if held:
        yield from done()


_LONGS = ("n_runs", "start", "length", "period", "exponent_milli")
_STRINGS = ("runs_sha256", "collapsed_sha256")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli)
    and the digests of all runs and of the words left, per row of ``docs``.

    Words: runs of anything but ASCII white space, of the whole text, after
    ``repeated_tail``.  A run is a stretch with smallest period q, of at least
    max(12, 2 q) words, that no neighbour extends.  Null, empty and blank
    texts have no words and no runs: 0, four nulls, digests of nothing.  A
    null doc_id changes no word.  Every row is judged by itself: repeated rows
    and ids give repeated results; equally long runs go by start, then period.
    A text of n words takes about 150 bytes a word, and 4 more for every
    doubling of its longest repeat; a text longer than BATCH_WORDS is alone in
    its array.  Other columns aren't read; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in _LONGS), *(T.StructField(c, T.StringType()) for c in _STRINGS)])
    types = [pa.int64()] * len(_LONGS) + [pa.string()] * len(_STRINGS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 512):
            columns = zip(*_documents(b["doc_id"].to_pylist(), b["text"].to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[f.name for f in schema])

    return docs.select("doc_id", "text").mapInArrow(rows, schema)
