"""Landed delimited files -> bronze raw and parsed tables.

Files land as ``<root>/<SOURCE>/<MARKET>/<file>`` (a hive-style
``market=<MARKET>`` folder is accepted too).  One scan of the lines feeds
both bronze tables:

1. ``read_lines``: text scan with file path and split (block) start; a
   monotonically increasing id gives each line's position inside its split.
   The lines are written once with their split keys and two flags; all that
   follows derives from that table, so no second scan has to cut the files
   the same way.
2. ``number_lines``: per-split counts (one row per split, tiny) are
   prefix-summed per file, measured and broadcast -> the file line number.
   No window over a whole file, so one huge file is still read by many tasks,
   and no shuffle of the text.
3. ``assemble_records``: a field that begins with a quote is enclosed and may
   hold tabs and newlines; a quote anywhere else in a field is data.  A line
   is a small state machine: where it ends (inside or outside a field) if it
   starts outside, and if it starts inside.  Files without a line that opens
   a field (the common case) need no assembly: record = line.  In the others
   the states of lines are chained within each split and of splits within the
   file, and the lines of each record are grouped.  An enclosed field that
   never ends is reported; the lines from its record on are records each, so
   nothing is lost and no record outgrows a task.
4. ``to_raw`` / ``to_parsed``: raw keeps the lines (or the record text);
   parsed binds the fields by position with ``from_csv`` (short rows are
   NULL-filled, long rows truncated, both flagged in ``_corrupt``).

The record number is the file line on which the record starts (header =
line 0, first data row = 1), shared by raw and parsed rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS, null_if_token, null_if_token_sql
from .schemas import RAW_SCHEMA, SOURCE_FOLDERS, payload_schema

QUOTE = '"'
BOM = "\ufeff"

# File-level issue codes.
UNBALANCED_QUOTES = "UNBALANCED_QUOTES"
INVALID_ENCODING = "INVALID_ENCODING"

CSV_OPTIONS = {
    "sep": "\t", "quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
}


# One field and its enclosure (possessive: no backtracking, no recursion).
_BODY = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:\x20*+"{_BODY}"[^\t]*+|(?!\x20*+")[^\t]*+)'
_OPENS = rf'(?:{_FIELD}\t)*+\x20*+"{_BODY}\z'
OPEN_FROM_OUTSIDE = rf'^{BOM}?{_OPENS}'
OPEN_FROM_INSIDE = rf'^{_BODY}\z|^{_BODY}"[^\t]*+\t{_OPENS}'


def read_lines(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """Every physical line of every file under ``path``, or of ``files``."""
    if files is not None and not files:
        return spark.createDataFrame([], "value string, file_path string, block_start bigint, _id bigint")
    return (spark.read.option("recursiveFileLookup", "true").text(path if files is None else files)
            .select(F.col("value"),
                    F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_block_start").alias("block_start"))
            .withColumn("_id", F.monotonically_increasing_id()))


def _prev_sum(col: str, w) -> Column:
    return F.coalesce(F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _keep(df: DataFrame) -> DataFrame:
    return df


def line_states(lines: DataFrame) -> DataFrame:
    """``lines`` with ``_out`` and ``_in``: whether the line ends inside an
    enclosed field if it starts outside of one, and if it starts inside."""
    return lines.select("*", F.col("value").rlike(OPEN_FROM_OUTSIDE).cast("int").alias("_out"),
                        F.col("value").rlike(OPEN_FROM_INSIDE).cast("int").alias("_in"), (~F.is_valid_utf8("value")).alias("_enc"))


#: Bytes of the split table that one broadcast may hold.
BROADCAST_BYTES = 64 << 20


#: Bytes of a split besides its path, at most.
SPLIT_BYTES = 100

#: Splits of a file where they weren't counted.
UNKNOWN = 1 << 31


def _at_splits(lines: DataFrame, splits: DataFrame, size: int) -> DataFrame:
    """``lines`` with the columns of their split.  The split table (written,
    of at most ``size`` bytes) is broadcast, in pieces by ranges of file paths
    where it is larger than BROADCAST_BYTES: the lines' row groups hold few
    paths each, so a piece reads its own ones, and the text isn't shuffled at
    any size."""
    keys = ["file_path", "block_start"]
    pieces = -(-size // BROADCAST_BYTES)
    if pieces <= 1:
        return lines.join(F.broadcast(splits), keys)
    ranged = splits.select("file_path").repartitionByRange(pieces, "file_path")
    starts = sorted(r[1] for r in ranged.groupBy(F.spark_partition_id()).agg(F.min("file_path")).collect())  # one per piece
    out = None
    for i, low in enumerate(starts):
        inside = F.col("file_path") >= low
        if i + 1 < len(starts):
            inside = inside & (F.col("file_path") < starts[i + 1])
        part = lines.filter(inside).join(F.broadcast(splits.filter(inside)), keys)
        out = part if out is None else out.unionByName(part)
    return out


def number_lines(lines: DataFrame, cut=_keep) -> tuple[DataFrame, int, int]:
    """Lines with ``line_no`` (0-based in the file) and file flags; the bytes
    of the split table and the most splits of a file that opens an enclosed
    field (0: none does), both observed as the table is written.

    ``cut`` materialises the per-split table (one row per split) so that
    every branch reading it scans a small table instead of re-running the
    aggregation over the whole input."""
    splits = (lines.groupBy("file_path", "block_start")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_id0"), F.max("_out").alias("_opens"),
                   F.max("_enc").alias("_enc")))
    by_file = Window.partitionBy("file_path").orderBy("block_start")
    whole = Window.partitionBy("file_path")
    splits = (splits
              .withColumn("_line0", _prev_sum("_n", by_file))
              .withColumn("_file_opens", F.max("_opens").over(whole) == 1)
              .withColumn("_file_bad_enc", F.max("_enc").over(whole)))
    lines = lines.drop("_enc")
    if cut is _keep:
        joined, size, opens = lines.join(splits.drop("_n", "_opens", "_enc"), ["file_path", "block_start"]), 0, UNKNOWN
    else:
        seen = Observation()
        splits = splits.withColumn("_splits", F.when(F.col("_file_opens"), F.count(F.lit(1)).over(whole)))
        splits = splits.observe(seen, F.sum(F.octet_length("file_path") + F.lit(SPLIT_BYTES)).alias("size"), F.max("_splits").alias("opens"))
        splits = cut(splits.drop("_n", "_opens", "_enc", "_splits"))
        size, opens = (seen.get.get(c) or 0 for c in ("size", "opens"))
        joined = _at_splits(lines, splits, size)
    return joined.withColumn("line_no", F.col("_line0") + F.col("_id") - F.col("_id0")), size, opens


def _chained(start: Column, flips: Column, last_set: Column) -> Column:
    """The state after a chain of steps, of which each sets it, flips it or
    keeps it: the last value set (or ``start``), turned by the flips since."""
    since = flips - F.coalesce(last_set["flips"], F.lit(0))
    return F.pmod(F.coalesce(last_set["value"], start) + since, F.lit(2)).cast("int")


def _chain(df: DataFrame, out: str, into: str, w) -> DataFrame:
    """``df`` with _flips and _set, the running sums behind ``_chained``."""
    flip = F.when((F.col(out) == 1) & (F.col(into) == 0), 1).otherwise(0)
    df = df.withColumn("_flips", F.sum(flip).over(w))
    fixed = F.when(F.col(out) == F.col(into), F.struct(F.col(out).alias("value"), F.col("_flips").alias("flips")))
    return df.withColumn("_set", F.last(fixed, ignorenulls=True).over(w))


def _across_splits(multi: DataFrame, cut, size: int) -> DataFrame:
    """Chained lines with the state in which their split starts (_from), the
    records begun before it (_first) and the file's records and end."""
    multi = cut(multi.select("file_path", "block_start", "_id", "line_no", "value", "_file_bad_enc",
                             *[f"_{c}{s}" for c in ("after", "before", "begun") for s in (0, 1)]))
    splits = multi.groupBy("file_path", "block_start").agg(
        *[F.max_by(f"_{c}{s}", "_id").alias(f"_{c}{s}") for c in ("after", "begun") for s in (0, 1)])
    by_file = Window.partitionBy("file_path").orderBy("block_start")
    splits = _chain(splits, "_after0", "_after1", by_file.rowsBetween(Window.unboundedPreceding, 0))
    splits = splits.withColumn("_ends", _chained(F.lit(0), F.col("_flips"), F.col("_set")))
    splits = splits.withColumn("_from", F.coalesce(F.lag("_ends").over(by_file), F.lit(0)))
    splits = splits.withColumn("_records", F.when(F.col("_from") == 0, F.col("_begun0")).otherwise(F.col("_begun1")))
    whole = Window.partitionBy("file_path")
    splits = cut(splits.withColumn("_first", _prev_sum("_records", by_file))
                 .withColumn("_file_records", F.sum("_records").over(whole))
                 .withColumn("_file_open_end", F.max_by("_ends", "block_start").over(whole) == 1)
                 .select("file_path", "block_start", "_from", "_first", "_file_records", "_file_open_end"))
    return multi.join(splits, ["file_path", "block_start"]) if cut is _keep else _at_splits(multi, splits, size)


def assemble_records(numbered: DataFrame, cut=_keep, size: int = 0, opens: int = UNKNOWN) -> DataFrame:
    """file_path, record_line, record, bad-file flags: one row per record.

    ``cut`` materialises the chained lines of files with enclosed newlines
    (only those files), which three later steps read, and their records.
    ``opens``: the most splits of such a file.  Without one every line is a
    record and nothing is assembled; where each is one split, its lines are
    chained from the file's start and grouped where they are, in one step."""
    flags = ["_file_open_end", "_file_bad_enc"]
    simple = (numbered.filter(~F.col("_file_opens"))
              .select("file_path", F.col("line_no").alias("record_line"), F.col("value").alias("record"),
                      F.lit(False).alias("_file_open_end"), "_file_bad_enc"))
    if not opens:
        return simple
    multi = numbered.filter(F.col("_file_opens"))
    order = Window.partitionBy("file_path", "block_start").orderBy("_id")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    multi = _chain(multi, "_out", "_in", upto)
    # the state after and before each line, and records begun, if the split starts so
    starts = (0,) if opens == 1 else (0, 1)
    multi = multi.select("*", *[_chained(F.lit(s), F.col("_flips"), F.col("_set")).alias(f"_after{s}") for s in starts])
    multi = multi.select("*", *[F.coalesce(F.lag(f"_after{s}").over(order), F.lit(s)).alias(f"_before{s}") for s in starts])
    multi = multi.select("*", *[F.sum(1 - F.col(f"_before{s}")).over(upto).alias(f"_begun{s}") for s in starts])
    if opens == 1:
        whole, by = Window.partitionBy("file_path", "block_start"), ["file_path", "block_start", "_record_id"]
        multi = multi.select("*", F.col("_begun0").alias("_record_id"), F.max("_begun0").over(whole).alias("_file_records"),
                             (F.max_by("_after0", "_id").over(whole) == 1).alias("_file_open_end"))
        pick = lambda c: F.col(f"{c}0")
    else:
        multi, by = _across_splits(multi, cut, size), ["file_path", "_record_id"]
        pick = lambda c: F.when(F.col("_from") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
        multi = multi.withColumn("_record_id", F.col("_first") + pick("_begun"))
    multi = multi.withColumn("_alone", (F.col("_file_open_end") & (F.col("_record_id") == F.col("_file_records")))
                                       | ((pick("_before") == 0) & (pick("_after") == 0)))
    # whole lines, and what follows a field that never ends, take no grouping
    single = (multi.filter(F.col("_alone"))
              .select("file_path", F.col("line_no").alias("record_line"), F.col("value").alias("record"), *flags))
    grouped = (multi.filter(~F.col("_alone"))
               .groupBy(*by)
               .agg(F.min("line_no").alias("record_line"),
                    F.array_sort(F.collect_list(F.struct("line_no", "value"))).alias("_parts"),
                    *[F.first(f).alias(f) for f in flags])
               .select("file_path", "record_line",
                       F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("record"),
                       *flags))
    return simple.unionByName(cut(single.unionByName(grouped)))


def _relative(file_path: Column, root: str) -> Column:
    tail = root.split(":", 1)[1] if root.startswith("file:") else root
    tail = "/" + tail.strip("/")
    return F.regexp_extract(F.url_decode(file_path), r"^.*?\Q" + tail + r"\E/(.*)$", 1)


def market_of(rel: Column) -> Column:
    """SPLIT_PART(path, '/', 2); a hive-style ``market=X`` folder gives X."""
    return F.regexp_replace(F.split_part(rel, F.lit("/"), F.lit(2)), "^market=", "")


@dataclass
class Landed:
    """Assembled records of one source plus the files with an issue."""
    records: DataFrame      # market, source_file, file_row_number, record, _open_end, _bad_enc
    file_issues: DataFrame  # source_file, issue
    lines: DataFrame | None = None  # physical lines: market, source_file, file_row_number, value, _bad_enc


def land(spark: SparkSession, root: str, source: str, cut_lineage: bool = False, files: list[str] | None = None) -> Landed:
    """Scan ``<root>/<SOURCE>/`` and assemble records.

    With ``cut_lineage`` the text is scanned once: its lines are written to
    the shared folder with their split keys, and the reused intermediates
    (per-split table, chained lines) are written from there."""
    folder = f"{root.rstrip('/')}/{SOURCE_FOLDERS[source]}"
    return land_lines(read_lines(spark, folder, files), root, cut_lineage)


def land_lines(lines: DataFrame, root: str, cut_lineage: bool = False, numbered_lines=None) -> Landed:
    """Records from a lines frame (value, file_path, block_start, _id); also
    used on each micro-batch of the streaming ingest.  ``numbered_lines`` is
    called with the physical lines before the records are assembled."""
    from .layers import materialize
    cut = (lambda df: materialize(df, "ingest-step")) if cut_lineage else _keep
    numbered, size, opens = number_lines(cut(line_states(lines)), cut)
    rel = _relative(F.col("file_path"), root)
    physical = numbered.select(market_of(rel).alias("market"), rel.alias("source_file"),
                               F.col("line_no").cast("long").alias("file_row_number"),
                               F.regexp_replace("value", "^" + BOM, "").alias("value"),
                               F.col("_file_bad_enc").alias("_bad_enc"))
    if numbered_lines:
        numbered_lines(physical)
    recs = assemble_records(numbered, cut, size, opens)
    recs = recs.select(
        market_of(rel).alias("market"), rel.alias("source_file"),
        F.col("record_line").cast("long").alias("file_row_number"),
        F.regexp_replace("record", "^" + BOM, "").alias("record"),
        F.col("_file_open_end").alias("_open_end"), F.col("_file_bad_enc").alias("_bad_enc"))
    return Landed(recs, bad_files(recs), physical)


def bad_files(records: DataFrame) -> DataFrame:
    """source_file, issue: files that end inside an enclosed field (their rows
    are kept) and files that cannot be decoded (raw skips them)."""
    return (records.filter(F.col("_open_end") | F.col("_bad_enc"))
            .groupBy("source_file")
            .agg(F.max("_open_end").alias("_open"))
            .select("source_file", F.when(F.col("_open"), F.lit(UNBALANCED_QUOTES))
                    .otherwise(F.lit(INVALID_ENCODING)).alias("issue")))


def _ts(load_ts) -> Column:
    if isinstance(load_ts, Column):
        return load_ts.cast("timestamp_ntz")
    return F.lit(load_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def to_raw(landed: Landed, load_ts=None, mode: str = "line") -> DataFrame:
    """Raw bronze: one string per row; files that cannot be decoded are
    skipped whole (S10).

    ``mode="line"`` (default): every physical line, as the raw line format
    reads it: it knows no enclosure, so a quote never costs a row.
    ``mode="record"``: the assembled record, numbered like the parsed row.
    """
    ts = _ts(load_ts).alias("load_timestamp")
    rows, text = (landed.lines, "value") if mode == "line" else (landed.records, "record")
    return raw_rows(rows, text, ts)


def raw_rows(rows: DataFrame, text: str, ts: Column) -> DataFrame:
    r = rows.filter((F.col("file_row_number") > 0) & ~F.col("_bad_enc"))
    return r.select("market", "source_file", "file_row_number", ts,
                    null_if_token(F.trim(F.col(text)), NULL_TOKENS).alias("raw_data"))


def parse_records(records: DataFrame, source: str, fields: bool = True) -> DataFrame:
    """Bind fields by position (S2, S7-S9); keeps ``_corrupt`` for issues.
    Without ``fields`` only the verdict is bound."""
    schema = payload_schema(source).add("_corrupt", "string")
    parsed = records.withColumn("_p", F.from_csv(F.col("record"), schema.simpleString(), CSV_OPTIONS))
    names = [f.name for f in payload_schema(source).fields] if fields else []
    # one text per column: a listing has dozens, each a call into the JVM otherwise
    return parsed.selectExpr(*[c for c in records.columns if c != "_p"], *[f"{null_if_token_sql(f'_p.{n}')} as {n}" for n in names], "_p._corrupt as _corrupt")


def to_parsed(landed: Landed, source: str, load_ts=None, keep_corrupt: bool = False,
              keep_raw: bool = False) -> DataFrame:
    """Parsed bronze: metadata + all-string payload (ON_ERROR=CONTINUE, S11).

    ``keep_raw`` carries the record text as ``raw_data`` from the same scan,
    so staging needs no lineage join back to the raw table."""
    p = parse_records(landed.records.filter(F.col("file_row_number") > 0), source)
    cols = ["market", "source_file", "file_row_number", _ts(load_ts).alias("load_timestamp")]
    cols += [f.name for f in payload_schema(source).fields]
    if keep_corrupt:
        cols.append("_corrupt")
    if keep_raw:
        cols.append(null_if_token(F.trim(F.col("record")), NULL_TOKENS).alias("raw_data"))
    return p.select(*cols)


def parse_issues(parsed_with_corrupt: DataFrame) -> DataFrame:
    """Rows the parser flagged (short / long / malformed), with their text."""
    return (parsed_with_corrupt.filter(F.col("_corrupt").isNotNull())
            .select("market", "source_file", "file_row_number", F.col("_corrupt").alias("record")))


@dataclass
class BronzeLoad:
    raw: DataFrame
    parsed: DataFrame
    file_issues: DataFrame
    parse_issues: DataFrame | None = None  # rows kept NULL-filled / truncated (ON_ERROR=CONTINUE)


def ingest(spark: SparkSession, root: str, source: str, load_ts=None,
           staged_records: bool = True, keep_raw: bool = False, raw_mode: str = "line", files: list[str] | None = None) -> BronzeLoad:
    """Both bronze tables of one source from a single scan.

    ``staged_records`` writes the lines, and the records that span lines, once
    to the shared folder (lineage cut), so no output re-runs the scan or the
    record assembly.
    """
    landed = land(spark, root, source, staged_records, files)
    ts = _ts(load_ts) if load_ts is not None else _ts(None)
    issues = parse_issues(parse_records(landed.records.filter(F.col("file_row_number") > 0), source, fields=False))
    return BronzeLoad(to_raw(landed, ts, raw_mode), to_parsed(landed, source, ts, keep_raw=keep_raw),
                      landed.file_issues, issues)


RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
