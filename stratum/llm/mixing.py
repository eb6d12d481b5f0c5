"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a hash.  Copy e of a document finishes
at the virtual time (e * source size + words up to and with the document) /
target.  The mix is the start of the global order by finish time, cut where
its words reach the budget; sources then stand near their targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, fresh, saved

#: Rows that one task sorts, on average.
ROWS_PER_BUCKET = 10_000


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null: 0."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size), one row
    per source.  Sources by code point, null last, get ``weights`` in turn and
    share all words; a target stops at ``most`` times its source, the excess
    goes to the others by weight.

    Ordered by cap per weight, the capped sources are a prefix: the level is
    (words - caps before) / (weights from here) at the first source that it
    leaves below its cap."""
    every = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    turn = F.array(*map(F.lit, weights))
    ranked = ranked.withColumn("_w", F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("_cap", F.col("source_size") * most)
    up = Window.orderBy(F.col("_cap") / F.col("_w"), "rank")
    ranked = (ranked.withColumn("_left", F.sum("source_size").over(every) - F.sum("_cap").over(up) + F.col("_cap"))
              .withColumn("_weights", F.sum("_w").over(every) - F.sum("_w").over(up) + F.col("_w")))
    free = F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_weights")
    level = F.first(F.when(free, F.col("_left") / F.col("_weights")), ignorenulls=True).over(
        up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("_cap").cast("double"), F.coalesce(level * F.col("_w"), F.col("_cap").cast("double")))
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per document.

    taken = size * copies.  Null and empty texts have size 0.  A null source
    is a source of its own, the last.  Equal rows stand together in the order;
    the cut counts rows that tie in everything as one, so reruns agree.  A
    source without words has target 0 and its documents are taken once.
    Other columns aren't read.  An empty table gives an empty result.
    """
    return _mix(docs, weights, most, seed).drop("source")


def _mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of ``mix`` with their source.  Rows that agree in doc_id, source
    and size agree in all."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    base = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")), "mix-sizes")
    buckets = max(1, base.count() // ROWS_PER_BUCKET)
    bucket = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2 ** 32)).cast("int")
    base = base.withColumn("bucket", bucket)
    parts = base.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goal = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    goal = saved(goal, "mix-targets")

    by = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = parts.select("source", "bucket", F.coalesce(F.sum("words").over(by), F.lit(0)).alias("before"))
    known = start.alias("s").join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        F.col("s.source").alias("_source"), F.col("s.bucket").alias("_bucket"), "before", "source_size", "rank", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    timed = (base.withColumn("_words", F.sum("size").over(inside))
             .join(known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
             .withColumn("cum", F.col("before") + F.col("_words")))
    timed = saved(timed.select("doc_id", "source", "size", "key", "rank", "source_size", "target", "cum"), "mix-times")

    def order(e: Column) -> Column:
        """What copy e is sorted by; the key's tail makes ties rare and fair."""
        finish = F.when(F.col("target") > 0, (e * F.col("source_size") + F.col("cum")) / F.col("target")).otherwise(F.lit(0.0))
        return F.struct(finish.alias("finish"), F.col("rank"), F.col("key"), F.col("doc_id"), F.col("size"))

    copies = timed.select("size", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("e"), "*").select(
        timed["size"].alias("words"), order(F.col("e")).alias("at"))
    budget = goal.agg(F.sum("source_size").alias("b")).first()["b"] or 0
    cut = _cut(copies.filter(F.col("words") > 0), budget, buckets)
    if cut is None:
        taken = F.lit(0)
    else:
        edge = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["rank"]).alias("rank"), F.lit(cut["key"]).alias("key"),
                        F.lit(cut["doc_id"]).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(cut["size"]).alias("size"))
        taken = sum(F.when(order(F.lit(e)) <= edge, 1).otherwise(0) for e in range(most))
    taken = F.when(F.col("source_size") == 0, 1).otherwise(taken)
    return timed.select("doc_id", "source", "size", "source_size", "target", taken.cast("int").alias("copies")).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


def _cut(copies: DataFrame, budget: int, buckets: int):
    """The last place of the global order whose running words stay within
    ``budget`` (one row), or None.  Ranges of the finish time are summed first;
    only the range in which the budget ends is sorted."""
    fine, group = max(64, 16 * buckets), 1024
    ranged = copies.withColumn("range", F.floor(F.col("at.finish") * fine))
    sums = saved(ranged.groupBy("range").agg(F.sum("words").alias("words")).withColumn("group", F.floor(F.col("range") / group)), "mix-ranges")

    def reached(parts: DataFrame, by: str, before: int):
        """The first part in which the budget ends; parts are one in ``group``."""
        run = parts.select(by, "words", (F.lit(before) + F.sum("words").over(Window.orderBy(by))).alias("through"))
        return run.filter(F.col("through") > budget).orderBy(by).limit(1).first()

    coarse = reached(sums.groupBy("group").agg(F.sum("words").alias("words")), "group", 0)
    if coarse is None:
        last = copies.agg(F.max("at").alias("at")).first()
        return last and last["at"]
    at = reached(sums.filter(F.col("group") == coarse["group"]), "range", coarse["through"] - coarse["words"])
    before = at["through"] - at["words"]
    near = ranged.filter(F.col("range") == at["range"])
    cum = F.sum("words").over(Window.partitionBy("range").orderBy("at"))
    row = near.select("at", (F.lit(before) + cum).alias("through")).filter(F.col("through") <= budget).agg(F.max("at").alias("at")).first()
    if row["at"] is not None:
        return row["at"]
    return ranged.filter(F.col("range") < at["range"]).agg(F.max("at").alias("at")).first()["at"]


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` (all columns) with every row as often as the mix takes it, also
    rows that share a doc_id or have none: a row's id, source and size decide.
    The counts are broadcast while they are few; else documents are shuffled."""
    n = _mix(docs.select("doc_id", "source", "text"), **how)
    of_id, of_source, of_size, times, copy = fresh(docs, "id", "source", "size", "copies", "copy")
    counts = n.groupBy(F.col("doc_id").alias(of_id), F.col("source").alias(of_source), F.col("size").alias(of_size)).agg(F.max("copies").alias(times))
    counts = saved(counts.filter(F.col(times) > 0), "mix-copies")
    side = F.broadcast(counts) if counts.count() <= BROADCAST_IDS else counts
    out = docs.join(side, docs["doc_id"].eqNullSafe(F.col(of_id)) & docs["source"].eqNullSafe(F.col(of_source)) & (word_count(docs["text"]) == F.col(of_size)))
    return out.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy)).drop(copy)
