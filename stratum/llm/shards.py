"""Jump consistent hashing of stable keys to shards [DataFrame functions only].

``law`` is "key": the document id and the number of shards alone decide, and
one more shard only takes rows into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The generator's multiplier 2862933555777941757, in 16-bit parts from the lowest.
MULTIPLIER = 2862933555777941757
_C = [(MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]
_LOW = 0xFFFFFFFF
#: A key makes about ln(shards) jumps; more than this many has a chance below 1e-100.
MOST_JUMPS = 256
#: Rows that one task numbers, on average.
ROWS_PER_BUCKET = 100_000


def _low_product(half: Column, c0: int, c1: int) -> Column:
    """(half * (c0 + c1 * 2**16)) mod 2**32, without leaving 63 bits."""
    return (half * F.lit(c0) + (half * F.lit(c1)).bitwiseAND(F.lit(0xFFFF)) * F.lit(65536)).bitwiseAND(F.lit(_LOW))


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 mod 2**64 on 32-bit halves held in non-negative longs."""
    p1 = lo * F.lit(_C[1])
    low = lo * F.lit(_C[0]) + p1.bitwiseAND(F.lit(0xFFFF)) * F.lit(65536) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(p1, 16)
    high = carry + _low_product(lo, _C[2], _C[3]) + _low_product(hi, _C[0], _C[1])
    return high.bitwiseAND(F.lit(_LOW)), low.bitwiseAND(F.lit(_LOW))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a 64-bit key.  The loop of the method is a fold of
    at most ``shards`` steps: every step strictly raises the candidate."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
                     F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_LOW)).alias("lo"))

    def turn(s: Column, _: Column) -> Column:
        hi, lo = _step(s["hi"], s["lo"])
        nxt = F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.when(s["j"] < shards, F.struct(s["j"].alias("b"), nxt.alias("j"), hi.alias("hi"), lo.alias("lo"))).otherwise(s)

    steps = F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS)))
    return F.aggregate(steps, start, turn, lambda s: s["b"].cast("int"))


def number_slots(df: DataFrame, group: str, order: list[Column], rows: int, name: str) -> DataFrame:
    """Gapless number from 0 within ``group`` in the order of a hash bucket,
    then ``order``.  A group is numbered by many tasks: buckets get an offset
    from their counts, rows a number within their bucket."""
    from pyspark.sql import Window

    buckets = max(1, rows // ROWS_PER_BUCKET)
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = df.groupBy(group, "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select(group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    return (df.withColumn("_row", F.row_number().over(inside))
            .join(offset, [group, "_bucket"])
            .withColumn(name, (F.col("_offset") + F.col("_row") - 1).cast("long"))
            .drop("_bucket", "_row", "_offset"))


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus 1 (null and empty texts: 1).
    text_crc32: of the UTF-8 text (null as empty: 0).  Rows with a null doc_id
    share the key 0, so repeated runs agree.  Rows that are equal in all
    output columns are interchangeable and still get a slot each.  Other
    columns of ``docs`` are not read, whatever their names.  An empty table
    gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    out = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
                      jump_hash(key, shards).alias("shard"), jump_hash(key, shards + 1).alias("grown_shard"))
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size")]
    out = number_slots(out, "shard", order, docs.count(), "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

