"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Seeds are the n-grams of the test items that are rare in the corpus (their
document frequencies are counted over all of it), and in any case the rarer
half of every item's.  A document and an item that share a seed are aligned
around it, word by word, with local alignment; a score of ``least`` of the
item's best possible one marks an exact, edited or paraphrased copy.  Of short
items more is asked, see ``needed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, hashes, mix, saved

#: Fixed values of the alignment: a matching word, a differing one, a gap.
MATCH, DIFFER, GAP = 2, 1, 1
#: Aligned words that a copy has at least, or nearly all of a shorter item.
LEAST_WORDS = 6
#: An item shorter than a seed is a copy only where it is this share of a document.
SHORT_SHARE = 1 / 8
#: Words of test items that one pass over the documents holds; more take more passes.
BLOCK_WORDS = 2_000_000
#: A seed in this share of the documents or less is rare.
RARE = 0.01

_SPACED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the lower-case words; punctuation and white space separate."""
    return hashes(text.lower().encode("utf-8", "replace").translate(_SPACED).split()) if text else np.zeros(0, np.uint64)


def grams(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.full(len(h) - width + 1, width, np.uint64)
        for j in range(width):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[j: len(h) - width + 1 + j])
    return acc


#: Cells of the alignment that are held at once, about.
ALIGN_CELLS = 1 << 16


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the place after its last word."""
    # scores are kept plus the gaps to their place, so that a gap along the window
    # is a running maximum; in front is a place of score 0
    at = GAP * np.arange(-1, len(window))
    h, best, end = at.copy(), 0, 0
    rows = max(1, ALIGN_CELLS // max(1, len(window)))
    for lo in range(0, len(item) if len(window) else 0, rows):
        steps = np.where(item[lo: lo + rows, None] == window, MATCH + GAP, GAP - DIFFER)
        for step in steps:
            step += h[:-1]
            h[1:] -= GAP
            np.maximum(step, h[1:], out=step)
            np.maximum(step, at[1:], out=step)
            np.maximum.accumulate(step, out=h[1:])
            step[:] = h[1:]
        steps -= at[1:]
        if (top := int(steps.max())) > best:
            best, end = top, int(steps.argmax()) % len(window) + 1
    return best, end


def needed(words: int, least: float) -> float:
    """The score that marks a copy of an item: ``least`` of the best, but that
    of LEAST_WORDS words; of fewer words, all, from LEAST_WORDS on with one edit."""
    best = MATCH * words
    near = best - (MATCH + DIFFER if words >= LEAST_WORDS else 0)
    return max(least * best, min(near, MATCH * LEAST_WORDS))


class Seeds:
    """Test items of one pass: word hashes, and (width, gram) to (item, place)."""

    def __init__(self, ids: list, texts: list[np.ndarray], n: int):
        self.ids, self.items, self.n = ids, texts, n
        width, gram, item, place = [], [], [], []
        for i, t in enumerate(texts):
            g = grams(t, w := min(n, len(t))) if len(t) else t
            width.append(np.full(len(g), w if len(t) else 0))
            gram.append(g)
            item.append(np.full(len(g), i))
            place.append(np.arange(len(g)))
        width, gram, item, place = (np.concatenate(x) if x else np.zeros(0, int) for x in (width, gram, item, place))
        gram = gram.astype(np.uint64)
        order = np.lexsort((place, item, gram, width))
        self.width, self.gram, self.item, self.place = width[order], gram[order], item[order], place[order]
        self.key = {int(w): np.unique(self.gram[self.width == w]) for w in np.unique(self.width)}

    def words(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The different words of an item and how often it has each."""
        known = self.__dict__.setdefault("counts", {})
        if i not in known:
            known[i] = np.unique(self.items[i], return_counts=True)
        return known[i]

    def shared(self, i: int, window: np.ndarray) -> int:
        """Words that an item and a window have in common, repeats counted: no
        alignment matches more."""
        word, times = self.words(i)
        at = np.minimum(np.searchsorted(word, window), len(word) - 1)
        return int(np.minimum(np.bincount(at[word[at] == window], minlength=len(word)), times).sum())

    @staticmethod
    def of(state: dict) -> Seeds:
        """From the attributes of another, which is what is broadcast."""
        out = Seeds.__new__(Seeds)
        vars(out).update(state)
        return out

    def keep(self, rare: dict[int, np.ndarray]) -> Seeds:
        """With the given (rare) grams of each width only."""
        use = np.zeros(len(self.gram), bool)
        for w, g in rare.items():
            use |= (self.width == w) & np.isin(self.gram, g)
        cut = {c: getattr(self, c)[use] for c in ("width", "gram", "item", "place")}
        return Seeds.of({"ids": self.ids, "items": self.items, "n": self.n, "key": {w: np.sort(g) for w, g in rare.items()}} | cut)

    def found(self, h: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(width, places in h, grams) of the seeds in a document."""
        for w, key in self.key.items():
            g = grams(h, w)
            if len(g) and len(key):
                i = np.minimum(np.searchsorted(key, g), len(key) - 1)
                at = np.flatnonzero(key[i] == g)
                if len(at):
                    yield w, at, g[at]

    def copies(self, h: np.ndarray, least: float) -> list[tuple[int, float, int, int, int]]:
        """(item, score, seeds, start, end) of the items that a document copies."""
        starts: dict[int, list[int]] = {}
        for w, at, g in self.found(h):
            first, last = np.searchsorted(self.width, (w, w + 1))  # sorted by width, then gram
            low, high = (first + np.searchsorted(self.gram[first:last], g, side) for side in ("left", "right"))
            for p, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                for s in range(a, b):
                    starts.setdefault(int(self.item[s]), []).append(p - int(self.place[s]))
        out = []
        for i, begin in starts.items():
            item = self.items[i]
            if len(item) < self.n and len(item) < SHORT_SHARE * len(h):
                continue
            begin = sorted(begin)
            least_score = needed(len(item), least)
            # what a copy can lose to gaps: its seeds' diagonals are no further apart
            slack, best = int(MATCH * len(item) - least_score) // GAP, (0, 0, 0, 0)
            lo = 0
            for k in range(1, len(begin) + 1):
                if k == len(begin) or begin[k] - begin[k - 1] > slack:
                    left = max(0, begin[lo] - slack)
                    window = h[left: begin[k - 1] + len(item) + slack]
                    # more words than both have can't match
                    if MATCH * self.shared(i, window) >= least_score:
                        score, end = align(item, window)
                        if score > best[0]:
                            best = (score, k - lo, left, end)
                    lo = k
            score, n, left, end = best
            if score >= least_score:
                back = align(item[::-1], h[left: left + end][::-1])[1]
                out.append((i, score / (MATCH * len(item)), n, left + end - back, left + end))
        return out


def _passes(benchmark: DataFrame, n: int) -> list[Seeds]:
    """The distinct test items in blocks of a bounded number of words.  Items
    stream to the driver one block at a time; blocks are what is broadcast."""
    out, ids, texts, held = [], [], [], 0
    rows = benchmark.select("item_id", "text").distinct().filter("item_id is not null").orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        ids.append(r["item_id"])
        texts.append(tokens(r["text"]))
        held += len(texts[-1])
        if held >= BLOCK_WORDS:
            out.append(Seeds(ids, texts, n))
            ids, texts, held = [], [], 0
    if ids:
        out.append(Seeds(ids, texts, n))
    return out


def _rare(docs: DataFrame, seeds: Seeds, rare: float) -> Seeds:
    """``seeds`` without the n-grams that are frequent in ``docs``; of each
    item, the rarer half of its n-grams always stays."""
    known = docs.sparkSession.sparkContext.broadcast(vars(seeds))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, n = Seeds.of(known.value), 0
        hit = {w: np.zeros(len(k), np.int64) for w, k in s.key.items()}
        for b in chunks(batches):
            n += b.num_rows
            for text in b["text"].to_pylist():
                for w, _, g in s.found(tokens(text)):
                    hit[w][np.searchsorted(s.key[w], np.unique(g))] += 1
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([0], pa.int64()), pa.array([n], pa.int64())], ["width", "gram", "docs"])
        for w, c in hit.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([w] * len(at), pa.int32()), pa.array(s.key[w][at].view(np.int64)), pa.array(c[at])], ["width", "gram", "docs"])

    rows = docs.select("text").mapInArrow(count, "width int, gram bigint, docs bigint").groupBy("width", "gram").agg(F.sum("docs").alias("docs")).collect()
    total = next((r["docs"] for r in rows if r["width"] == 0), 0)
    freq = {(r["width"], r["gram"]): r["docs"] for r in rows if r["width"]}
    df = np.array([freq.get((int(w), int(g)), 0) for w, g in zip(seeds.width, seeds.gram.view(np.int64), strict=True)], np.int64)
    use = df <= rare * total
    for i in range(len(seeds.items)):
        own = np.flatnonzero(seeds.item == i) if len(seeds.items) < 2000 else _range(seeds, i)
        if len(own):
            use[own[df[own] <= np.median(df[own])]] = True
    return seeds.keep({w: np.unique(seeds.gram[use & (seeds.width == w)]) for w in seeds.key})


def _range(seeds: Seeds, item: int) -> np.ndarray:
    if not hasattr(seeds, "by_item"):
        seeds.by_item = np.argsort(seeds.item, kind="stable")
        seeds.item_ends = np.searchsorted(seeds.item[seeds.by_item], np.arange(len(seeds.items) + 1))
    return seeds.by_item[seeds.item_ends[item]: seeds.item_ends[item + 1]]


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5, rare: float = RARE) -> DataFrame:
    """doc_id, item_id, score, seeds, start, end: a row for each document and
    each test item that it copies.

    score: share of the item's best alignment score, ``least`` or more; items
    of fewer than 12 words need what 6 aligned words score, those of 6 and 7 one
    edit at most, those of 5 and fewer all words.  seeds: rare n-grams met;
    start, end: words of the copy within the document's words.  Items with
    fewer than ``n`` words are sought as one n-gram, in documents of up to eight times their
    words; null and empty items and
    texts match nothing, nor do items with a null id.  Repeated documents give
    repeated rows.  An empty benchmark or corpus gives no rows.  Other columns
    aren't read.
    """
    out = None
    ids = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {ids}, item_id {item_type}, score double, seeds int, start bigint, end bigint"
    for seeds in _passes(benchmark, n):
        known = docs.sparkSession.sparkContext.broadcast(vars(_rare(docs, seeds, rare)))

        def rows(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            s = Seeds.of(known.value)
            for b in chunks(batches):
                hit = [(i, c) for i, t in enumerate(b["text"].to_pylist()) for c in s.copies(tokens(t), least)]
                columns = [b["doc_id"].take(pa.array([i for i, _ in hit], pa.int64())), pa.array([s.ids[c[0]] for _, c in hit]),
                           *(pa.array([c[k] for _, c in hit], t) for k, t in ((1, pa.float64()), (2, pa.int32()), (3, pa.int64()), (4, pa.int64())))]
                if hit:
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "seeds", "start", "end"])

        part = docs.select("doc_id", "text").mapInArrow(rows, schema)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5, rare: float = RARE) -> DataFrame:
    """``docs`` (all columns) without the documents that copy a test item."""
    for seeds in _passes(benchmark, n):
        known = docs.sparkSession.sparkContext.broadcast(vars(_rare(docs, seeds, rare)))

        def rows(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            s = Seeds.of(known.value)
            for b in chunks(batches):
                yield b.filter(pa.array([not s.copies(tokens(t), least) for t in b["text"].to_pylist()], pa.bool_()))

        docs = saved(docs.mapInArrow(rows, docs.schema), "uncontaminated")
    return docs
