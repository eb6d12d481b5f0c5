"""J1 where raw and parsed rows were loaded apart: lines realigned by content.

The lineage join takes row numbers for granted.  Where the two loads read
different states of a file, numbers are shifted, lines are missing, doubled,
moved or changed.  ``attach_aligned`` finds each parsed row's raw line:

* ``same``      the file's lines agree in number and text; nothing to align
* ``unique``    the text occurs once in the parsed and once in the raw file
* ``extended``  a repeated text that lies where the nearest unique line before
                or after it leads to (their shift of row numbers)
* ``repeated``  what is left of a repeated text, k-th to k-th
* ``position``  no line of that text is free, but the lines before and after it
                lead to the same raw line, which nothing else took
* ``none``      no raw line (``raw_record`` is NULL)

A parsed and a raw line are paired at most once.  A unique line whose shift
differs from the equal shifts of the unique lines around it was moved: it is
paired, yet leads nowhere.  Before the first line the shift is 0 (header to
header), after the last it is the difference of the last row numbers.

Text means the bound fields (trimmed, NULL tokens as NULL), by their digest.
Both sides are read once and written with their digests.  Only digests and
numbers of files are shuffled until the raw text is attached.  Files of equal
digest sums are left out at the start.  Nearest lines are found within blocks
of row numbers, and from block to block by one row each, so that neither a
long file nor a text that fills a third of it is one task's work.

Rows with a NULL in their key have no raw line and are kept.  Rows that
repeat a key and a text are one line: all get its raw line.  Several texts
under one key are lines of their own.  Where raw rows of one key differ in
blanks only, the smallest text is taken.  Empty tables give no rows, or rows
of kind ``none``; further columns of ``parsed`` are carried along.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canon_market, null_if_token_sql
from ..sources.ingest import parse_records
from ..sources.schemas import SOURCE_FIELDS

FILE = ["market", "source_file"]
#: A line where files go by number, see ``_align``.
LINE = ["_file_id", "_row", "_fp"]

#: Row numbers per block.
BLOCK = 1 << 16


def fingerprint(source: str) -> Column:
    """Digest of a row's fields (16 bytes); NULL and an absent field are alike."""
    fields = ", ".join(f"coalesce({null_if_token_sql(f'trim({f})')}, char(1))" for f in SOURCE_FIELDS[source])
    return F.expr(f"unhex(md5(concat_ws(char(2), {fields})))")


def parsed_lines(parsed: DataFrame, source: str) -> DataFrame:
    """``parsed`` with its canonical market, ``_row`` and ``_fp``."""
    return (parsed.withColumn("market", canon_market("market"))
            .withColumns({"_row": F.col("file_row_number").cast("bigint"), "_fp": fingerprint(source)}))


def raw_lines(raw: DataFrame, source: str) -> DataFrame:
    """market, source_file, _row, raw_data, _fp."""
    lines = raw.select(canon_market("market").alias("market"), "source_file", F.col("file_row_number").cast("bigint").alias("_row"),
                       "raw_data", F.coalesce("raw_data", F.lit("")).alias("record"))
    return parse_records(lines, source).select(*FILE, "_row", "raw_data", fingerprint(source).alias("_fp"))


def _together(cut, *steps: DataFrame) -> list[DataFrame]:
    """Independent steps, submitted together so that their stages share the cores."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return list(pool.map(cut, steps))


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.select(*FILE, "_row", "_fp").dropna(subset=[*FILE, "_row"])


def _file_digest(lines: DataFrame, as_: str) -> DataFrame:
    digest = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("_row", "_fp")), F.sum(F.hash("_row", "_fp")))
    return lines.groupBy(*FILE).agg(digest.alias(as_))


def _around(rows: DataFrame, ends: DataFrame, block: int, cut) -> DataFrame:
    """``rows`` (lines with a ``_shift`` or NULL) with ``_before`` and
    ``_after``: the shifts of the nearest lines that have one.  The lines are
    dealt and written once; what leads from block to block is read from the
    outermost lines of each block."""
    at, place = ["_file_id", "_block"], ["_row", "_fp"]
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    up, down = (Window.partitionBy(*at).orderBy(*[o(c) for c in place]) for o in (F.asc, F.desc))
    rows = rows.withColumn("_block", F.floor(F.col("_row") / block))
    rows = cut(rows.select("*", F.last("_shift", True).over(past(up)).alias("_up"), F.lead(F.lit(1)).over(up).isNull().alias("_ends"),
                           F.last("_shift", True).over(past(down)).alias("_down"), F.lead(F.lit(1)).over(down).isNull().alias("_begins")))
    edges = rows.filter("_ends or _begins").groupBy(*at).agg(F.max(F.when(F.col("_ends"), F.coalesce("_shift", "_up"))).alias("_last"),
                                                             F.max(F.when(F.col("_begins"), F.coalesce("_shift", "_down"))).alias("_first"))
    earlier, later = (past(Window.partitionBy("_file_id").orderBy(o("_block"))) for o in (F.asc, F.desc))
    edges = (edges.select(*at, F.last("_last", True).over(earlier).alias("_from"), F.last("_first", True).over(later).alias("_to"))
             .join(ends, "_file_id", "left"))
    return (rows.join(edges, at)
            .withColumn("_before", F.coalesce("_up", "_from", F.lit(0)))
            .withColumn("_after", F.coalesce("_down", "_to", "_end", F.lit(0)))
            .drop("_block", "_up", "_down", "_ends", "_begins", "_from", "_to", "_end"))


def _open_lines(parsed: DataFrame, found: DataFrame, ends: DataFrame, block: int, cut) -> DataFrame:
    """Parsed lines without a match, with the shifts around them.  Lines found
    k-th to k-th lead nowhere, nor do those that were moved."""
    shift = F.when(F.col("match_kind") != "repeated", F.col("_raw_row") - F.col("_row"))
    rows = _around(parsed.join(found.select(*LINE, "match_kind", shift.alias("_shift")), LINE, "left"), ends, block, cut)
    moved = (F.col("_before") == F.col("_after")) & (F.col("_shift") != F.col("_before"))
    rows = rows.select(*LINE, "match_kind", F.when(~moved, F.col("_shift")).alias("_shift"))
    return _around(rows, ends, block, cut).filter("match_kind is null").select(*LINE, "_before", "_after")


def _free_raw(free: DataFrame, matched: DataFrame) -> DataFrame:
    """Raw lines (file, _raw_row, _fp) without a match."""
    taken = matched.select("_file_id", "_raw_row", F.col("_raw_fp").alias("_fp"))
    return free.join(taken, ["_file_id", "_raw_row", "_fp"], "left_anti")


def _match(df: DataFrame, how: str, raw_fp: str = "_fp") -> DataFrame:
    return df.select(*LINE, "_raw_row", F.col(raw_fp).alias("_raw_fp"), F.lit(how).alias("match_kind"))


def _ranked(lines: DataFrame, row: str, block: int) -> DataFrame:
    """``lines`` with ``_k``, their place among the lines of their file and text."""
    text, at = ["_file_id", "_fp"], ["_file_id", "_fp", "_block"]
    lines = lines.withColumn("_block", F.floor(F.col(row) / block))
    earlier = Window.partitionBy(*text).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(*at, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_k0"))
    place = F.row_number().over(Window.partitionBy(*at).orderBy(row))
    return lines.join(counts, at).select(*text, row, (F.col("_k0") + place).alias("_k"))


def _align(parsed: DataFrame, raw: DataFrame, cut, block: int) -> tuple[DataFrame, DataFrame]:
    """The files that both sides have, numbered (FILE, _file_id, and in _same
    whether their lines agree), and the pairs of the others, by those numbers:
    LINE, _raw_row, _raw_fp, match_kind."""
    files = _file_digest(parsed, "_ours").join(_file_digest(raw, "_theirs"), FILE)
    files = cut(files.select(*FILE, F.monotonically_increasing_id().alias("_file_id"), (F.col("_ours") == F.col("_theirs")).alias("_same")))
    other = files.filter(~F.col("_same"))
    parsed, raw = _together(cut, *[df.join(other, FILE).select(*LINE).distinct() for df in (parsed, raw)])
    last = lambda df, c: df.groupBy("_file_id").agg(F.max("_row").alias(c))
    ends = last(parsed, "_p").join(last(raw, "_r"), "_file_id").select("_file_id", (F.col("_r") - F.col("_p")).alias("_end"))
    raw = raw.withColumnRenamed("_row", "_raw_row")

    texts = parsed.withColumn("_raw_row", F.lit(None).cast("bigint")).unionByName(raw.withColumn("_row", F.lit(None).cast("bigint")))
    once = (texts.groupBy("_file_id", "_fp").agg(F.count("_row").alias("_n"), F.count("_raw_row").alias("_m"), F.min("_row").alias("_row"), F.min("_raw_row").alias("_raw_row"))
            .filter("_n = 1 and _m = 1"))
    matched = cut(_match(once, "unique"))

    free = cut(_free_raw(raw, matched))
    led = _open_lines(parsed, matched, ends, block, cut)
    led = led.select(*LINE, F.explode(F.array_distinct(F.array(F.col("_row") + F.col("_before"), F.col("_row") + F.col("_after")))).alias("_raw_row"))
    led = led.join(free, ["_file_id", "_raw_row", "_fp"])
    led = led.groupBy("_file_id", "_fp", "_raw_row").agg(F.min("_row").alias("_row"))
    led = cut(_match(led.groupBy(*LINE).agg(F.min("_raw_row").alias("_raw_row")), "extended"))
    leading = matched.unionByName(led)

    left = _ranked(parsed.join(leading.select(*LINE), LINE, "left_anti"), "_row", block)
    free = cut(_free_raw(free, led))
    repeated = cut(_match(left.join(_ranked(free, "_raw_row", block), ["_file_id", "_fp", "_k"]), "repeated"))
    found = leading.unionByName(repeated)

    between = _open_lines(parsed, found, ends, block, cut).filter("_before = _after")
    between = between.groupBy("_file_id", "_row").agg(F.min("_fp").alias("_fp"), F.min(F.col("_row") + F.col("_before")).alias("_raw_row"))
    free = _free_raw(free, repeated).groupBy("_file_id", "_raw_row").agg(F.min("_fp").alias("_free_fp"))
    changed = _match(between.join(free, ["_file_id", "_raw_row"]), "position", "_free_fp")
    return files, found.unionByName(changed)


def align_lines(parsed: DataFrame, raw: DataFrame, cut, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The files whose lines agree, and for the others FILE, _row, _fp of
    ``parsed`` (both sides: these columns, keys not NULL) with its ``_raw_row``,
    ``_raw_fp`` and ``match_kind``; lines without a raw line are left out.
    ``cut`` writes a step's result and reads it back."""
    files, pairs = _align(cut(parsed), cut(raw), cut, block)
    named = pairs.join(files.select("_file_id", *FILE), "_file_id")
    return files.filter("_same").select(*FILE), named.select(*FILE, *[c for c in pairs.columns if c != "_file_id"])


def attach_aligned(parsed: DataFrame, raw: DataFrame, source: str, block: int = BLOCK) -> DataFrame:
    """Every parsed row with ``raw_row_number``, ``raw_record`` and
    ``match_kind``."""
    from ..sources.layers import materialize
    cut = lambda df: materialize(df, "alignment")
    # read for the alignment and for the result: digested once
    ours, theirs = _together(cut, parsed_lines(parsed, source), raw_lines(raw, source))
    files, pairs = _align(_keyed(ours), _keyed(theirs), cut, block)
    texts = theirs.join(files, FILE).filter(F.col("_row").isNotNull()).groupBy(*LINE).agg(F.min("raw_data").alias("raw_record"))
    texts = texts.withColumnsRenamed({"_row": "_raw_row", "_fp": "_raw_fp"})
    # a file that agrees leads each line to itself; only lines of the others look up their pair
    ours = ours.join(files, FILE, "left").join(cut(pairs), LINE, "left")
    own = lambda c, own: F.coalesce(c, F.when(F.col("_same"), F.col(own)))
    ours = ours.withColumns({"_raw_row": own("_raw_row", "_row"), "_raw_fp": own("_raw_fp", "_fp")})
    kind = F.when(F.col("_same") & F.col("_row").isNotNull(), F.lit("same")).otherwise(F.coalesce("match_kind", F.lit("none")))
    return (ours.join(texts, ["_file_id", "_raw_row", "_raw_fp"], "left")
            .select(*parsed.columns, F.col("_raw_row").alias("raw_row_number"), "raw_record", kind.alias("match_kind")))
