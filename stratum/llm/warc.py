"""WARC archives: records written by Spark's text sink, read back by
boundary-chain verification.

A scan cut at the record magic emits one candidate per occurrence, also for
those inside payloads, with the offset of its successor by its own length
header.  Pointer jumping from the start of each file keeps the candidates that
the chain of successors reaches; all others are payload.  Files are split
anywhere and no task holds a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import BROADCAST_IDS, saved

#: Fixed values of the format.
MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: ten hex digits are eight of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.upper(F.conv(F.substring(digits, 10 * i + 1, 10), 16, 32)), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


#: Control characters and all that ends a line somewhere (also NEL, LS, PS).
UNSAFE = r"[\p{Cc}\p{Zl}\p{Zp}]"


def _uri(url: Column) -> Column:
    """``url`` with its unsafe characters percent-encoded."""
    coded = F.transform(F.split(url, ""), lambda c: F.when(c.rlike(UNSAFE), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c))
    return F.when(url.rlike(UNSAFE), F.array_join(coded, "")).otherwise(url)


def _record(kind: str, payload: Column, refers_to: Column | None) -> Column:
    """A record without magic's successor: header, blank line, payload."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    target = F.coalesce(line("WARC-Target-URI", _uri(F.col("url"))), F.lit(""))
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.lit(kind)), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), ident, F.lit(">"))),
        target, line("WARC-Date", F.lit(DATE)), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers_to.cast("string"), F.lit(">"))) if refers_to is not None else F.lit(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length(payload).cast("string")), F.lit("\r\n"), payload)


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write a record per row of ``pages`` (page_id, url, html).

    Among equal payloads of ``least_bytes`` and more the row with the largest
    page_id is the response, the others revisit it; smaller payloads are all
    responses.  A null html is an empty payload.  Rows that repeat the largest
    page_id, and rows with a null page_id, are responses.  Payloads are not
    shuffled unless the revisits are too many to broadcast their ids."""
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("body")).withColumn("digest", base32_sha1(F.col("body").cast("binary"))).withColumn(
        "bytes", F.octet_length("body").cast("long"))
    narrow = rows.select("page_id", "url", "digest", "bytes")
    groups = narrow.groupBy("digest", "bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    groups = groups.filter((F.col("n") > 1) & (F.col("bytes") >= least_bytes)).drop("n")
    again = saved(narrow.join(groups, ["digest", "bytes"]).filter(F.col("page_id") < F.col("first")), "warc-revisits")
    ids = again.select("page_id", "digest").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    first = rows.join(ids, ["page_id", "digest"], "left_anti").select(_record("response", F.col("body"), None).alias("record"))
    later = again.select(_record("revisit", F.lit(""), F.col("first")).alias("record"))
    first.union(later).write.option("lineSep", END).text(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """What stands between occurrences of the magic, in file order by id."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"))


def _numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with the offset in the file at which each starts: summed within
    its split, plus the lengths of the earlier splits."""
    step = F.col("length") + len(MAGIC)
    inside = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    totals = lines.groupBy("file", "split").agg(F.sum(step).alias("total"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", "split", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return lines.withColumn("_in", F.coalesce(F.sum(step).over(inside), F.lit(0))).join(base, ["file", "split"]).withColumn(
        "at", F.col("base") + F.col("_in")).drop("_in", "base")


def _header(head: Column, name: str) -> Column:
    """The value of a header line; lines end with CR LF and nothing else."""
    return F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _reached(nodes: DataFrame) -> DataFrame:
    """(file, split, run, entry): runs of candidates that the chain reaches, and
    where it enters them.  A run is a stretch of candidates within a split of
    which each is the successor of the one before; the jumps are between runs."""
    runs = nodes.groupBy("file", "split", "run").agg(F.max_by("next", "at").alias("exit"))
    into = nodes.select("file", F.col("split").alias("to_split"), F.col("run").alias("to_run"), F.col("at").alias("entry"))
    jump = saved(runs.join(into, (runs["file"] == into["file"]) & (runs["exit"] == into["entry"])).select(
        runs["file"], "split", "run", "to_split", "to_run", "entry"), "warc-jumps")
    reached = nodes.filter(F.col("at") == len(MAGIC)).select("file", "split", "run", F.col("at").alias("entry"))
    while True:
        reached = saved(reached.union(reached.drop("entry").join(jump, ["file", "split", "run"]).select(
            "file", F.col("to_split").alias("split"), F.col("to_run").alias("run"), "entry")), "warc-reached")
        if not jump.limit(1).count():
            return reached
        two = jump.select("file", F.col("split").alias("to_split"), F.col("run").alias("to_run"),
                          F.col("to_split").alias("s"), F.col("to_run").alias("r"), F.col("entry").alias("e"))
        jump = saved(jump.join(two, ["file", "to_split", "to_run"]).select(
            "file", "split", "run", F.col("s").alias("to_split"), F.col("r").alias("to_run"), F.col("e").alias("entry")), "warc-jumps")


def read(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """file, offset, type, record_id, refers_to, uri, declared_digest,
    declared_bytes, content_length, digest: a row per record on the chain.

    digest: of the payload as read.  Payloads may hold the magic and whole
    records; a record whose length header is missing, no number or wrong ends
    the chain of its file there, which is an error unless ``whole_files`` is
    False.  An empty file has no records.  Header lines end with CR LF; no
    other character starts one.  Records of any size are read; one whose
    payload holds the magic is put together in one task."""
    value = F.col("value").cast("binary")
    head = F.substring_index("value", END, 1)
    lines = _lines(spark, path).withColumn("length", F.octet_length("value").cast("long")).withColumn("head", head)
    lines = lines.withColumn("skip", F.octet_length("head").cast("long") + len(END)).withColumn(
        "content_length", F.regexp_extract(_header(F.col("head"), "Content-Length"), r"^([0-9]+)[ \t]*$", 1).try_cast("bigint"))
    whole = F.col("length") >= F.col("skip") + F.col("content_length") + len(END)
    payload = F.substring(value, (F.col("skip") + 1).cast("int"), F.col("content_length").cast("int"))
    known = [_header(F.col("head"), n).alias(c) for n, c in (
        ("WARC-Type", "type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "uri"),
        ("WARC-Payload-Digest", "declared_digest"), ("WARC-Payload-Length", "declared_bytes"))]
    seen = saved(lines.select("file", "split", "id", "length", "skip", "content_length", *known, F.when(whole, base32_sha1(payload)).alias("digest")), "warc-candidates")

    placed = saved(_numbered(seen), "warc-places")
    in_split = Window.partitionBy("file", "split").orderBy("at")
    nodes = placed.filter((F.col("at") > 0) & F.col("content_length").isNotNull()).withColumn(
        "next", F.col("at") + F.col("skip") + F.col("content_length") + len(END) + len(MAGIC))
    apart = F.when(F.lag("next").over(in_split) == F.col("at"), 0).otherwise(1)
    nodes = nodes.withColumn("_apart", apart).withColumn("run", F.sum("_apart").over(in_split)).drop("_apart")
    nodes = saved(nodes, "warc-nodes")
    on = saved(nodes.join(_reached(nodes.select("file", "split", "run", "at", "next")), ["file", "split", "run"]).filter(F.col("at") >= F.col("entry")), "warc-chain")

    if whole_files:
        ends = placed.groupBy("file").agg(F.max(F.col("at") + F.col("length")).alias("end"))
        reached = on.groupBy("file").agg(F.max("next").alias("upto"))
        short = [r["file"] for r in ends.join(reached, "file", "left").filter(F.coalesce(F.col("upto") - len(MAGIC), F.lit(0)) != F.col("end")).limit(5).collect()]
        if short:
            raise ValueError(f"the chain of records stops before the end of {', '.join(short)}")
    out = on.filter("digest is not null")
    cut = on.filter("digest is null")
    if cut.limit(1).count():
        out = out.unionByName(_joined(spark, path, cut, nodes.columns + ["entry"]))
    return out.select("file", (F.col("at") - len(MAGIC)).alias("offset"), "type", "record_id", "refers_to", "uri", "declared_digest", "declared_bytes", "content_length", "digest")


def _joined(spark: SparkSession, path: str, cut: DataFrame, columns: list[str]) -> DataFrame:
    """``cut`` records, whose payloads hold the magic, with their digests.  The
    files that have any are read again; a group is the pieces of one record."""
    files = cut.select("file").distinct()
    pieces = saved(_lines(spark, path).join(files, "file", "left_semi").withColumn("length", F.octet_length("value").cast("long")), "warc-pieces")
    spans = cut.select("file", F.col("at").alias("from"), "next")
    placed = _numbered(pieces.select("file", "split", "id", "length")).select("file", "split", "id", "at")
    # the record before or at each piece: both sides sorted together, one file at a time, without values
    marks = spans.select("file", F.col("from").alias("at"), "next", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("split")).unionByName(
        placed.withColumn("next", F.lit(None).cast("long")))
    order = Window.partitionBy("file").orderBy("at", F.col("id").asc_nulls_first())
    owner = marks.withColumn("owner", F.last(F.when(F.col("next").isNotNull(), F.struct(F.col("at").alias("from"), "next")), ignorenulls=True).over(order))
    owner = owner.filter("id is not null and owner is not null and at < owner.next - 10").select("file", "split", "id", "at", F.col("owner.from").alias("from"))
    parts = pieces.join(owner, ["file", "split", "id"]).groupBy("file", "from").agg(
        F.array_sort(F.collect_list(F.struct("at", F.col("value").cast("binary").alias("value")))).alias("parts"))
    body = F.aggregate("parts", F.lit(b""), lambda acc, p: F.when(F.length(acc) == 0, p["value"]).otherwise(F.concat(acc, F.lit(MAGIC.encode()), p["value"])))
    back = cut.drop("digest").join(parts.select("file", F.col("from").alias("at"), body.alias("body")), ["file", "at"])
    payload = F.substring(F.col("body"), (F.col("skip") + 1).cast("int"), F.col("content_length").cast("int"))
    whole = F.length("body") >= F.col("skip") + F.col("content_length") + len(END)
    return back.withColumn("digest", base32_sha1(payload)).filter(whole).select(*columns)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: a row
    per row of ``pages``, all read back from the archives written for them.

    A response's bytes and digest are those of the payload as read; a revisit
    has none and carries its response's in its header.  Null ids are kept;
    repeated rows are records of their own; other columns aren't read; no
    pages make no records."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc", unique=True)
    write(pages, path, least_bytes)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, 'urn:page:(-?[0-9]+)', 1) AS bigint)")
    response = F.col("type") == "response"
    return read(spark, path).select(
        number("record_id").alias("page_id"),
        F.when(response, F.col("content_length")).otherwise(F.expr("try_cast(declared_bytes AS bigint)")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.regexp_replace("declared_digest", "^sha1:", "")).alias("payload_digest"),
        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))
