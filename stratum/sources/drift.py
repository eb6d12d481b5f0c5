"""Files whose header differs from the layout (S9, S2): bound by name.

Fields are bound by position.  Where a file's header line names other columns
than the layout, its positions are looked up first:

* a column whose name is that of a field (letters and digits, in any case)
  is that field, the first one where a name comes twice;
* of the rest, a column and a field that are each other's only nearest name,
  at most a quarter of the field's letters apart (edit distance), are the same;
* other fields are missing (NULL in every row), other columns are ignored.

A header in which less than half of the layout's names are found says nothing
about the columns: such a file stays bound by position.  Headers are one line
per file; the lookup joins them with the layout, never with rows.  The table
of drifted files is measured, and broadcast only if it is small.

A drifted file's rows are short or long (``_corrupt``) by its own header; files
are taken together by their number of columns.  A
file without lines has no header and no drift.  Rows that repeat, and enclosed
fields with tabs or newlines, are bound as everywhere.  Names hold no tabs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS, alnum_lower, null_if_token
from .ingest import BROADCAST_BYTES, CSV_OPTIONS, Landed, _ts, parse_records
from .layers import materialize
from .schemas import SOURCE_FIELDS

# Kinds of drift.
MOVED, RENAMED, MISSING, ADDED, UNRECOGNISED = "moved", "renamed", "missing", "added", "unrecognised"


def _layout(spark, source: str) -> DataFrame:
    rows = [(i, f) for i, f in enumerate(SOURCE_FIELDS[source])]
    return spark.createDataFrame(rows, "position int, field string").withColumn("_name", alnum_lower("field"))


def _columns(records: DataFrame, source: str) -> DataFrame:
    """source_file, found_position, found_name, _name, _width: the columns of
    headers that aren't the layout's."""
    names = F.split("record", "\t")
    plain = [alnum_lower(F.lit(f)) for f in SOURCE_FIELDS[source]]
    return (records.filter("file_row_number = 0").select("source_file", names.alias("_names"))
            .filter(F.transform("_names", alnum_lower) != F.array(*plain))
            .select("source_file", F.size("_names").alias("_width"), F.posexplode("_names").alias("found_position", "found_name"))
            .withColumn("found_name", F.trim(F.regexp_replace("found_name", '"', "")))
            .withColumn("_name", alnum_lower("found_name")))


def _nearest(pairs: DataFrame, by: list[str]) -> DataFrame:
    """The pairs that are the only nearest one of theirs in ``by``."""
    near = Window.partitionBy("source_file", *by)
    pairs = pairs.withColumn("_least", F.min("_far").over(near))
    pairs = pairs.withColumn("_ties", F.count_if(F.col("_far") == F.col("_least")).over(near))
    return pairs.filter("_far = _least and _ties = 1").drop("_least", "_ties")


def header_bindings(records: DataFrame, source: str) -> DataFrame:
    """One row per field and column of the files whose header drifted:
    source_file, field, position, found_name, found_position, renamed, _width;
    a field without column and a column without field have NULLs."""
    layout = F.broadcast(_layout(records.sparkSession, source))
    columns = materialize(_columns(records, source), "headers")
    first = F.row_number().over(Window.partitionBy("source_file", "field").orderBy("found_position")) == 1
    exact = columns.join(layout, "_name").withColumn("_first", first).filter("_first").drop("_first")
    known = exact.groupBy("source_file").agg(F.count(F.lit(1)).alias("_known"))
    files = columns.select("source_file", "_width").distinct().join(known, "source_file", "left")
    files = files.withColumn("recognised", F.coalesce("_known", F.lit(0)) * 2 >= len(SOURCE_FIELDS[source])).drop("_known")

    known_files = files.filter("recognised").select("source_file", "_width")
    fields = known_files.crossJoin(layout.select("field", "position", F.col("_name").alias("_field_name")))  # a layout's few fields per file
    open_fields = fields.join(exact.select("source_file", "field"), ["source_file", "field"], "left_anti")
    columns = columns.join(known_files.select("source_file"), "source_file", "left_semi")
    open_columns = columns.join(exact.select("source_file", "found_position"), ["source_file", "found_position"], "left_anti")
    pairs = open_fields.drop("_width").join(open_columns, "source_file").withColumn("_far", F.levenshtein("_field_name", "_name"))
    mutual = _nearest(pairs, ["field"]).join(_nearest(pairs, ["found_position"]).select("source_file", "field", "found_position"),
                                             ["source_file", "field", "found_position"])
    mutual = mutual.filter(F.col("_far") * 4 <= F.length("_field_name"))
    keep = ["source_file", "field", "found_position", "found_name"]
    bound = exact.select(*keep, F.lit(False).alias("renamed")).unionByName(mutual.select(*keep, F.lit(True).alias("renamed")))
    of_fields = fields.drop("_field_name").join(bound, ["source_file", "field"], "left")
    spare = open_columns.join(mutual.select("source_file", "found_position"), ["source_file", "found_position"], "left_anti")
    strangers = files.filter(~F.col("recognised")).select("source_file", "_width")
    return (of_fields.unionByName(spare.select("source_file", "found_position", "found_name", "_width"), allowMissingColumns=True)
            .unionByName(strangers, allowMissingColumns=True))


def drift_of(bindings: DataFrame) -> DataFrame:
    """source_file, kind, field, position, found_name, found_position (from 0)."""
    kind = (F.when(F.col("field").isNull() & F.col("found_position").isNull(), UNRECOGNISED)
            .when(F.col("field").isNull(), ADDED).when(F.col("found_position").isNull(), MISSING)
            .when(F.col("renamed"), RENAMED).when(F.col("position") != F.col("found_position"), MOVED))
    return (bindings.withColumn("kind", kind).filter("kind is not null")
            .select("source_file", "kind", "field", "position", "found_name", "found_position"))


def _bound(records: DataFrame, files: DataFrame, source: str, width: int) -> DataFrame:
    """``records`` of the files with ``width`` columns, fields by name."""
    schema = ", ".join([f"c{i} string" for i in range(width)] + ["_corrupt string"])
    rows = records.join(files, "source_file")
    rows = rows.withColumn("_p", F.from_csv("record", schema, CSV_OPTIONS))
    rows = rows.withColumn("_texts", F.transform(F.array(*[F.col(f"_p.c{i}") for i in range(width)]), lambda t: null_if_token(t, NULL_TOKENS)))
    texts = F.transform("_places", lambda at: F.get("_texts", at))
    rows = rows.select(*records.columns, texts.alias("_fields"), F.col("_p._corrupt").alias("_corrupt"))
    return rows.select(*records.columns, *[F.get("_fields", F.lit(i)).alias(f) for i, f in enumerate(SOURCE_FIELDS[source])], "_corrupt")


def parse_by_header(landed: Landed, source: str, load_ts=None) -> tuple[DataFrame, DataFrame]:
    """The parsed rows (as ``ingest.to_parsed`` with ``_corrupt``) and the
    drift table.  Files with the layout's header are bound by position."""
    bindings = materialize(header_bindings(landed.records, source), "header-bindings")
    files = bindings.filter("field is not null").groupBy("source_file", "_width").agg(
        F.array_sort(F.collect_list(F.struct("position", "found_position")))["found_position"].alias("_places"))
    size = bindings.agg(F.sum(F.octet_length("source_file") + 64)).first()[0] or 0
    records = landed.records.filter("file_row_number > 0")
    widths = [r[0] for r in files.select("_width").distinct().collect()]
    small = F.broadcast if size <= BROADCAST_BYTES else lambda df: df
    if widths:
        files = materialize(files, "drifted-files")
        parsed = parse_records(records.join(small(files.select("source_file")), "source_file", "left_anti").select(*records.columns), source)
        for w in sorted(widths):  # few; each reads the records once more
            parsed = parsed.unionByName(_bound(records, small(files.filter(F.col("_width") == w).drop("_width")), source, w))
    else:
        parsed = parse_records(records, source)
    meta = ["market", "source_file", "file_row_number"]
    return parsed.select(*meta, _ts(load_ts).alias("load_timestamp"), *SOURCE_FIELDS[source], "_corrupt"), drift_of(bindings)
