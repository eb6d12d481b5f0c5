"""Exact n-gram Jaccard join as a metric-space join.

Documents with equal shingle sets are one point.  Every point is cut, by hash
range, into more slices than a linked pair can have differing shingles, so
linked points agree in whole slices.  Of its shared slices a point may forget
the most frequent ones, as many as are to spare: the rarest slice of a linked
pair stays on both sides.  The points that share a slice elect the smallest as
pivot, and the points that met a pivot are its region.  Inside a region the
Jaccard distance to the pivot bounds that between members: by the triangle
inequality only members whose pivot distances differ by at most the link
distance are compared.  Regions too large for a task are split again: pivots
from the region span Voronoi cells, a point joins each cell whose pivot is at
most two link distances further than its nearest one (these windows hold all
links), and the cells join recursively.  Where distances are too even for
cells to shrink, the region is split into pairs of hash blocks instead.  Every
link is verified on the whole sets; components come from the links.

Links are counted inside the components, where every pair has one owner: a
component is one group, or pairs of hash blocks where it is large.  Distances
to a pivot decide most pairs: their sum within the link distance makes a
link, their difference beyond it none; the others are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, chunks, components, fresh, hashes, mix, saved, semi, shingles, words

#: A region with more shingles or documents is split before it is joined.  A
#: task takes about 100 bytes a shingle of the region in hand.
LEAF_SHINGLES, LEAF_DOCS = 500_000, 4096
#: Bits of a region's table of members by shared shingles (16 MB); larger ones are kept as postings.
MOST_BITS = 1 << 27
#: Pivots of a split, and splits before blocks are taken.
PIVOTS, MOST_LEVELS = 12, 3


def classes(least: int, top: int = 1 << 40) -> list[tuple[int, int, int, int]]:
    """Size classes (from, to, slices, spare); a pair belongs to the class of
    its smaller set.

    A set of n shingles differs from a linked one that is no smaller in at
    most (100 - least) * n / least shingles.  With that many slices for the
    largest n of the class, and 1 + spare more, 1 + spare slices agree."""
    out, low = [], 1
    while low < top:
        high = max(low + 1, math.ceil(low * 1.6))
        t = (100 - least) * (high - 1) // least
        spare = 2 + math.ceil(0.2 * t)
        out.append((low, high, t + 1 + spare if t else 0, spare))
        low = high
    return out


#: The low bits of a signature hold its size class.
CLASS_BITS = 127


def signatures(s: np.ndarray, least: int, plan: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Hashes of the slices of a set: for its size class, and for the smaller
    classes that hold sets it can link with."""
    n, found = len(s), []
    mixed = None
    for c, (low, high, slices, _) in enumerate(plan):
        if n < low:
            break
        if not slices or least * n > 100 * (high - 1):
            continue
        with np.errstate(over="ignore"):
            if mixed is None:
                mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s), dtype=np.uint64)])
            at = ((s >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)  # slices are ranges of the sorted hashes
            ends = np.searchsorted(at, np.arange(slices + 1, dtype=np.uint64))
            place = np.arange(slices, dtype=np.uint64) * np.uint64(1_000_003) + np.diff(ends).astype(np.uint64) * np.uint64(65_537) + np.uint64(c)
            sig = mix(mixed[ends[1:]] - mixed[ends[:-1]] + mix(place))
        found.append(sig & ~np.uint64(CLASS_BITS) | np.uint64(c))
    return np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)


def _point(s: np.ndarray) -> int:
    """The 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, the point x and the text's digest t of every row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            sets = (shingles(hashes(words(t)), k) for t in b["text"].to_pylist())
            n, x = zip(*((len(s), _point(s)) for s in sets), strict=True) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(x, pa.int64()), b["t"]], ["doc_id", "n_shingles", "x", "t"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(rows, f"doc_id {kind}, n_shingles bigint, x bigint, t bigint")


def _filed(docs: DataFrame, k: int, least: int) -> DataFrame:
    """(sig, x): the slices of every point, once per task at least; copies
    within a task are left out before anything is shuffled."""
    plan = classes(least)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in chunks(batches):
            sigs, xs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for t in b["text"].to_pylist():
                s = shingles(hashes(words(t)), k)
                if len(s) and (x := _point(s)) not in seen:
                    seen.add(x)
                    sigs.append(signatures(s, least, plan))
                    xs.append(np.full(len(sigs[-1]), x))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(xs))], ["sig", "x"])

    return docs.filter("doc_id is not null").select("text").mapInArrow(rows, "sig bigint, x bigint")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(x, shingles) of the rows' points, each once per task at most."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in chunks(batches):
            sets = {_point(s): s.tobytes() for s in (shingles(hashes(words(t)), k) for t in b["text"].to_pylist())}
            new = [x for x in sets if x not in seen]
            seen.update(new)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int64()), pa.array([sets[x] for x in new], pa.binary())], ["x", "shingles"])

    return docs.select("text").mapInArrow(rows, "x bigint, shingles binary")


def _linked(a: int, b: int, common: int, least: int) -> bool:
    return 100 * common >= least * (a + b - common)


class _Region:
    """Members of a region (the first is the pivot) and what they have in common."""

    def __init__(self, sets: list[np.ndarray]):
        n = len(sets)
        self.size = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        by = np.argsort(flat, kind="stable")
        flat = flat[by]
        new = np.concatenate([[True], flat[1:] != flat[:-1]])
        shared = ~new | np.append(~new[1:], False)  # only shingles of two members and more can be common
        column = (np.cumsum(new & shared) - 1)[shared].astype(np.int32)
        row = np.repeat(np.arange(n, dtype=np.int32), self.size)[by[shared]]
        del flat, by, new, shared
        wide = int(column[-1]) + 1 if len(column) else 0
        self.bits = None
        if n * wide <= MOST_BITS:
            bits = np.zeros((n, max(1, -(-wide // 64)) * 8), np.uint8)
            np.bitwise_or.at(bits, (row, column >> 3), (1 << (column & 7)).astype(np.uint8))
            self.bits = bits.view(np.uint64)
        else:
            self.post, self.ends = row, np.searchsorted(column, np.arange(wide + 1))
            mine = np.argsort(row, kind="stable")
            self.own, self.start = column[mine], np.searchsorted(row[mine], np.arange(n + 1))
        every = np.arange(n)
        c = self.common(0, every)
        self.away = 1 - c / (self.size + self.size[0] - c)  # Jaccard distance to the pivot
        self.away[0] = 0.0
        self.order = np.argsort(self.away, kind="stable")

    def common(self, i: int, js: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            step = max(1, (1 << 20) // self.bits.shape[1])
            return np.concatenate([np.bitwise_count(self.bits[js[at: at + step]] & self.bits[i]).sum(axis=1, dtype=np.int64) for at in range(0, len(js), step)])
        mine = [self.post[self.ends[c]: self.ends[c + 1]] for c in self.own[self.start[i]: self.start[i + 1]]]
        return np.bincount(np.concatenate(mine), minlength=len(self.size))[js] if mine else np.zeros(len(js), np.int64)

    def linked(self, i: int, js: np.ndarray, least: int) -> np.ndarray:
        """Those of ``js`` that link with member i."""
        js = js[100 * np.minimum(self.size[js], self.size[i]) >= least * np.maximum(self.size[js], self.size[i])]
        if not len(js):
            return js
        c = self.common(i, js)
        return js[100 * c >= least * (self.size[i] + self.size[js] - c)]


def join_region(ids: list, sets: list[np.ndarray], least: int) -> list[tuple]:
    """A spanning forest (a, b) of the links of one region; the first member is
    the pivot.  Pairs that are connected already aren't compared."""
    n = len(ids)
    group = np.arange(n)
    out = []

    def unite(i: int, j: int) -> None:
        out.append((ids[i], ids[j]))
        group[group == group[j]] = group[i]

    if n <= 6:
        for i in range(n):
            for j in range(i + 1, n):
                if group[i] != group[j] and _linked(len(sets[i]), len(sets[j]), len(np.intersect1d(sets[i], sets[j], assume_unique=True)), least):
                    unite(i, j)
        return out
    r = _Region(sets)
    radius = 1 - least / 100 + 1e-9
    away = r.away[r.order]
    for at, i in enumerate(r.order):
        window = r.order[at + 1: np.searchsorted(away, away[at] + radius, side="right")]
        for j in r.linked(i, window[group[window] != group[i]], least):
            if group[i] != group[j]:
                unite(i, j)
    return out


def count_links(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, least: int) -> np.ndarray:
    """Copies of the other members that each member links with.  Only members
    of different sides are compared; side -1 is compared with all others."""
    n = len(sets)
    found = np.zeros(n, np.int64)
    if n <= 6:
        for i in range(n):
            for j in range(i + 1, n):
                if (side[i] != side[j] or side[i] < 0) and _linked(len(sets[i]), len(sets[j]), len(np.intersect1d(sets[i], sets[j], assume_unique=True)), least):
                    found[i] += copies[j]
                    found[j] += copies[i]
        return found
    r = _Region(sets)
    radius = 1 - least / 100
    away, order = r.away[r.order], r.order
    # certain: the distances to the pivot add up to no more than the link distance
    sure = np.searchsorted(away, radius - 1e-9 - away, side="right")
    upto = {s: np.concatenate([[0], np.cumsum(np.where(side[order] == s, copies[order], 0))]) for s in set(side.tolist())}
    for s, total in upto.items():
        others = np.flatnonzero(side[order] < 0) if s < 0 else np.flatnonzero(side[order] != s)
        found[order[others]] += total[sure[others]]
    own = np.flatnonzero((side[order] < 0) & (sure > np.arange(n)))
    found[order[own]] -= copies[order[own]]
    for at, i in enumerate(order):
        window = order[max(at + 1, sure[at]): np.searchsorted(away, away[at] + radius + 1e-9, side="right")]
        js = r.linked(i, window if side[i] < 0 else window[side[window] != side[i]], least)
        found[i] += copies[js].sum()
        found[js] += copies[i]
    return found


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Members (ids, sets) of each region of a partition sorted by region, x."""
    now, ids, sets = None, [], []
    for b in chunks(batches):
        for region, x, s in zip(b["region"].to_pylist(), b["x"].to_pylist(), b["shingles"].to_pylist(), strict=True):
            if region != now and ids:
                yield ids, sets
                ids, sets = [], []
            now = region
            if not ids or ids[-1] != x:  # a point may come from several tasks
                ids.append(x)
                sets.append(np.frombuffer(s, np.uint64))
    if ids:
        yield ids, sets


def _join(regions: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) of all regions (region, x) that fit a task.  Sets are sent
    once per region that a point is in."""
    kind = regions.schema["x"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, members in _regions(batches):
            if found := join_region(ids, members, least):
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found]), pa.array([b for _, b in found])], ["a", "b"])

    full = regions.select("region", "x").join(sets, "x").select("region", "x", "shingles")
    return full.repartition("region").sortWithinPartitions("region", "x").mapInArrow(rows, f"a {kind}, b {kind}")


def _cells(large: DataFrame, sizes: DataFrame, sets: DataFrame, least: int, level: int, pivots: int, leaf: int) -> DataFrame:
    """One Voronoi split of the regions (region, x, n): rows (region, x, n,
    parent) of the cells.  A region is dealt to pieces; the pivots precede the
    members in each, so a task holds the pivots of one region."""
    kind = large.schema["x"].dataType.simpleString()
    pieces = sizes.select("region", F.ceil(F.col("cost") / leaf).cast("int").alias("pieces"))
    chosen = large.groupBy("region", F.pmod(F.xxhash64("x", F.lit(level)), F.lit(pivots)).alias("slot")).agg(F.min("x").alias("x")).select("region", "x")
    first = chosen.join(pieces, "region").select("region", "x", F.lit(0).cast("bigint").alias("n"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    members = large.join(pieces, "region").select("region", "x", "n", F.pmod(F.xxhash64("x", F.lit(-2)), F.col("pieces")).cast("int").alias("piece"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius = 1 - least / 100 + 1e-9
        now, ps = None, []
        for b in chunks(batches):
            out = [[], [], [], []]
            for region, piece, x, n, s in zip(*(b[c].to_pylist() for c in ("region", "piece", "x", "n", "shingles")), strict=True):
                if (region, piece) != now:
                    now, ps = (region, piece), []
                own = np.frombuffer(s, np.uint64)
                if not n:  # a pivot; it may come from several tasks
                    if not ps or ps[-1][0] != x:
                        ps.append((x, own))
                    continue
                away = []
                for _, p in ps:
                    c = len(np.intersect1d(own, p, assume_unique=True))
                    away.append(1 - c / max(1, len(own) + len(p) - c))
                nearest = min(away)
                for (at, _), d in zip(ps, away, strict=True):
                    if d <= nearest + 2 * radius:
                        cell = np.uint64(xxhash.xxh3_64_intdigest(str(at), seed=region & 0xFFFFFFFFFFFFFFFF)).view(np.int64)
                        for column, value in zip(out, (int(cell), x, n, region), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], b["x"].type), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                                             ["region", "x", "n", "parent"])

    both = first.unionByName(members).join(sets, "x").select("region", "piece", "x", "n", "shingles")
    cells = both.repartition("region", "piece").sortWithinPartitions("region", "piece", F.col("n") > 0, "x").mapInArrow(
        rows, f"region bigint, x {kind}, n bigint, parent bigint")
    return cells.distinct()  # a set may be there once per task that read a copy of it


def _blocks(large: DataFrame, costs: DataFrame, leaf: int, leaf_docs: int) -> DataFrame:
    """Regions as pairs of hash blocks, of which two fit a task."""
    parts = costs.select("region", F.greatest(F.ceil(F.col("cost") * 2 / leaf), F.ceil(F.col("docs") * 2 / leaf_docs)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("x", F.lit(-1)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = large.join(parts, "region").withColumn("own", own).withColumn("other", other)
    return rows.select(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("region"), "x", "n")


def _met(docs: DataFrame, k: int, least: int) -> DataFrame:
    """(pivot, x): the points that share a slice with a pivot, without what a
    point may forget."""
    same = Window.partitionBy("sig")
    shared = _filed(docs, k, least).select("sig", "x", F.count("*").over(same).alias("often"), F.min("x").over(same).alias("pivot"),
                                           F.max("x").over(same).alias("last")).filter("pivot < last")
    size_class = F.col("sig").bitwiseAND(F.lit(CLASS_BITS)).cast("int")
    spare = F.element_at(F.array(*(F.lit(c[-1]) for c in classes(least))), size_class + 1)
    own = Window.partitionBy("x", "class").orderBy(F.desc("often"), "sig")
    ranked = shared.withColumn("class", size_class).withColumn("rank", F.dense_rank().over(own))
    return ranked.filter(F.col("rank") > spare).select("pivot", "x").distinct()


def links(points: DataFrame, docs: DataFrame, k: int, least: int, leaf: int = LEAF_SHINGLES, leaf_docs: int = LEAF_DOCS,
          pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """(a, b): links that connect the same points as all links do; and the sets
    (x, shingles) of all points that have one, some repeated.  ``points``: (x,
    n, rep), one row per point."""
    regions = _met(docs, k, least).join(points.select("x", "n"), "x").select(F.xxhash64("pivot").alias("region"), "x", "n")
    regions = saved(regions, "jaccard-regions")
    many = regions.groupBy("region").count().filter("count > 1").select("region")
    regions = saved(regions.join(many, "region", "left_semi"), "jaccard-regions")
    active = points.join(regions.select("x").distinct(), "x", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    sets = saved(_sets(semi(docs, active, "doc_id"), k), "jaccard-sets")
    found = []
    for level in range(MOST_LEVELS + 1):
        costs = saved(regions.groupBy("region").agg(F.sum("n").alias("cost"), F.count("*").alias("docs")), "jaccard-costs")
        over = (F.col("cost") > leaf) | (F.col("docs") > leaf_docs)
        large = costs.filter(over)
        found.append(_join(regions.join(large, "region", "left_anti"), sets, least))
        if not large.limit(1).count():
            break
        rest = saved(regions.join(large, "region", "left_semi"), "jaccard-large")
        if level < MOST_LEVELS - 1:
            cells = saved(_cells(rest, large, sets, least, level, pivots, leaf), "jaccard-cells")
            grown = cells.groupBy("parent", "region").agg(F.sum("n").alias("cost")).groupBy("parent").agg(
                F.max("cost").alias("largest"), F.sum("cost").alias("total"))
            good = large.join(grown, large["region"] == grown["parent"]).filter("largest < 0.7 * cost and total < 3 * cost").select("region")
            regions = cells.join(good.withColumnRenamed("region", "parent"), "parent", "left_semi").select("region", "x", "n")
            even = large.join(good, "region", "left_anti")
        else:
            regions, even = rest.limit(0), large
        final = _blocks(rest.join(even, "region", "left_semi"), even, leaf, leaf_docs)
        found.append(_join(final, sets, least))
        regions = saved(regions, "jaccard-regions")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return saved(out, "jaccard-links"), sets


def _degrees(members: DataFrame, sets: DataFrame, least: int, leaf: int = LEAF_SHINGLES, leaf_docs: int = LEAF_DOCS, **_) -> DataFrame:
    """(x, links): the copies of other points that each point links with.
    ``members``: (c, x, n, copies) of all components with links."""
    kind = members.schema["x"].dataType.simpleString()
    costs = members.groupBy("c").agg(F.sum("n").alias("cost"), F.count("*").alias("docs"))
    parts = costs.select("c", F.when((F.col("cost") <= leaf) & (F.col("docs") <= leaf_docs), 1).otherwise(
        F.greatest(F.ceil(F.col("cost") * 2 / leaf), F.ceil(F.col("docs") * 2 / leaf_docs))).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("x", F.lit(-1)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    # a pair of blocks is one group; within a block the members have side -1
    rows = members.join(parts, "c").withColumn("own", own).withColumn("other", other).select(
        "c", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "x", "copies",
        F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            links = count_links(held, np.array(copies, np.int64), np.array(side), least) if len(xs) > 1 else np.zeros(len(xs), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(xs), pa.array(links)], ["x", "links"])

        now, xs, held, copies, side = None, [], [], [], []
        for b in chunks(batches):
            for key, x, k, s, h in zip(zip(*(b[c].to_pylist() for c in ("c", "low", "high")), strict=True), *(b[c].to_pylist() for c in ("x", "copies", "side", "shingles")), strict=True):
                if key != now and xs:
                    yield done()
                    xs, held, copies, side = [], [], [], []
                now = key
                if not xs or xs[-1] != x:
                    xs.append(x)
                    copies.append(k)
                    side.append(s)
                    held.append(np.frombuffer(h, np.uint64))
        if xs:
            yield done()

    full = rows.join(sets, "x").repartition("c", "low", "high").sortWithinPartitions("c", "low", "high", "x")
    return full.mapInArrow(counted, f"x {kind}, links bigint").groupBy("x").agg(F.sum("links").alias("links"))


def _grouped(docs: DataFrame, k: int, least: int, count: bool = False, **how) -> DataFrame:
    """doc_id, n_shingles, t, component_id, first (and with ``count`` n_links):
    one row per row of ``docs``.  first: this id and text are the smallest of
    their component; null without words or id."""
    s = saved(sketch(docs, k), "jaccard-sketch")
    real = s.filter("n_shingles > 0 and doc_id is not null")
    points = real.groupBy("x").agg(F.max("n_shingles").alias("n"), F.min(F.struct("doc_id", "t")).alias("m"), F.count("*").alias("copies"))
    points = saved(points.select("x", "n", "copies", F.col("m.doc_id").alias("rep"), F.col("m.t").alias("t")), "jaccard-points")
    found, sets = links(points, docs, k, least, **how)
    comp = saved(components(found, "jaccard-components").withColumnRenamed("v", "x"), "jaccard-components")
    known = points.join(comp, "x", "left").select("x", "rep", "t", F.coalesce("c", "x").alias("c"), "copies")
    least_row = known.groupBy("c").agg(F.min(F.struct("rep", "x", "t")).alias("m"))
    known = known.join(least_row, "c").select("x", "m", "copies")
    if count:
        degrees = saved(_degrees(points.join(comp, "x").select("c", "x", "n", "copies"), sets, least, **how), "jaccard-degrees")
        known = known.join(degrees, "x", "left").select("x", "m", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    first = (F.col("doc_id") == F.col("m.rep")) & (s["x"] == F.col("m.x")) & (F.col("t") == F.col("m.t"))
    return s.join(known, "x", "left").select(
        "doc_id", "n_shingles", "t", F.when(linked, F.col("m.rep")).otherwise(F.col("doc_id")).alias("component_id"), F.when(linked, first).alias("first"),
        *([F.when(linked, F.col("n_links")).otherwise(0).alias("n_links")] if count else []))


def near_duplicates(docs: DataFrame, k: int = 5, least: int = 80, **how) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: one row per row of ``docs``.

    Words: runs of anything but ASCII white space, A-Z lower-cased.  A set:
    distinct ``k``-word shingles of the whole text; fewer words make one
    shingle; null and empty texts make none and link with nothing.  Documents
    link when 100 * common >= ``least`` * union.  component_id: smallest
    doc_id that links reach, the own one included.  n_links: the other rows
    that link with this one, copies included.  Repeated texts are one point,
    named by a 64-bit digest.  Rows that share a doc_id are told apart by
    their texts.  Rows with a null doc_id link with nothing and have a null
    component.  Very long texts are one set, read whole; an empty table gives
    no rows.  Other columns aren't read.  Counting compares the different
    texts of one component in pairs where their distances to a pivot leave it
    open: its cost grows with the square of their number.
    """
    return _grouped(docs, k, least, count=True, **how).select("doc_id", "n_shingles", "component_id", "n_links")


def keep_one(docs: DataFrame, k: int = 5, least: int = 80, **how) -> DataFrame:
    """``docs`` (all columns) with one row of each group of near duplicates: the
    one with the smallest doc_id (of several texts under it that are near
    duplicates, one; of equal ids and texts, the row whose JSON is smallest).
    Other rows that share its doc_id stay unless they are near duplicates
    themselves.  Documents without words or without an id stay.  Columns of
    any name and type are kept as they are; very long texts are read whole; an
    empty table stays empty."""
    found = saved(_grouped(docs, k, least, **how).filter("first is not null").groupBy("doc_id", "t", "first").count(), "jaccard-groups")
    key, digest, row = fresh(docs, "id", "digest", "row")

    def of(rows: DataFrame, some: str, kind: str) -> DataFrame:
        keys = found.filter(some).select(F.col("doc_id").alias(key), F.col("t").alias(digest))
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
        return rows.join(keys, (rows["doc_id"] == F.col(key)) & (F.xxhash64(rows["text"]) == F.col(digest)), kind)

    out = of(docs, "not first", "left_anti")
    again = "first and count > 1"
    if not found.filter(again).limit(1).count():
        return out
    whole = F.struct(*(F.col(f"`{c}`") for c in out.columns))
    one = of(out, again, "left_semi").groupBy("doc_id", F.xxhash64("text")).agg(F.min_by(whole, F.to_json(whole)).alias(row))
    return of(out, again, "left_anti").unionByName(one.select(f"{row}.*"))
