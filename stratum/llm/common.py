"""Helpers shared by the training-data operators: word hashing inside tasks,
tables written to the shared folder, size-checked semi joins, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layers import materialize as saved

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of ids that may be broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 512 rows, unless the session has a size of its own:
    the default of 10,000 long texts is too much for a task's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "512")


def chunks(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of the batches: Python objects are made of few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
        pa.default_memory_pool().release_unused()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while f"_{name}" in taken:
            name = f"_{name}"
        taken.add(f"_{name}")
        out.append(f"_{name}")
    return out


def words(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z lower-cased; bytes.split() cuts at exactly the
    ASCII white space of WORD."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all k-word windows; fewer words than ``k``
    make one shingle of the whole sequence; no words make none."""
    if not len(h):
        return h
    width = min(k, len(h))
    with np.errstate(over="ignore"):
        acc = np.full(len(h) - width + 1, width, np.uint64)
        for j in range(width):
            acc = mix(acc * _M2 + h[j: len(h) - width + 1 + j])
    return np.unique(acc)


def semi(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (distinct, one column).  The ids
    are counted first: few are broadcast, so ``df`` isn't shuffled."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, "left_semi")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(v, c): the smallest vertex that links reach, for every vertex of
    ``edges`` (a, b).  Smallest-label rounds with a pointer jump in each;
    every round is written to the shared folder and reread, so lineage stays
    short and a lost executor costs one round at most."""
    both = saved(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                 .union(edges.select("b", "a")).distinct(), f"{name}-edges")
    label = saved(both.groupBy("u").agg(F.min("v").alias("m"))
                  .select(F.col("u").alias("v"), F.least("u", "m").alias("c"), F.lit(True).alias("moved")), f"{name}-0")
    turn = 0
    while label.filter("moved").limit(1).count():
        turn += 1
        near = both.join(label.select("v", "c"), "v").groupBy("u").agg(F.min("c").alias("m"))
        low = label.join(near.withColumnRenamed("u", "v"), "v").select("v", "c", F.least("c", "m").alias("n"))
        up = label.select(F.col("v").alias("n"), F.col("c").alias("above"))
        label = saved(low.join(up, "n").select("v", F.least("n", "above").alias("n"), "c")
                      .select("v", F.col("n").alias("c"), (F.col("n") != F.col("c")).alias("moved")), f"{name}-{turn}")
    return label.select("v", "c")
