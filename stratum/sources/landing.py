"""Write landing files (delimited text with a header) from a DataFrame.

Used to land data derived from the driver tables so the ingest path can be
run end to end.  Fields are encoded with CSV quoting rules written as SQL
(identical in Spark and DuckDB): NULL -> empty, '' -> "", a value that holds a
tab or newline or begins with a quote is enclosed with inner quotes doubled.  Files go to
``<root>/<SOURCE>/market=<M>/bucket=<B>/``, one file per folder, rows in
``seq`` order after the header line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schemas import SOURCE_FIELDS, SOURCE_FOLDERS


def encode_sql(x: str) -> str:
    return (f"case when {x} is null then '' when {x} = '' then '\"\"' "
            f"when instr({x}, chr(9)) > 0 or instr({x}, chr(10)) > 0 or instr({x}, chr(13)) > 0 "
            f"or ltrim({x}) like '\"%' then concat('\"', replace({x}, '\"', '\"\"'), '\"') else {x} end")


def line_sql(source: str, values: dict[str, str]) -> str:
    """Tab-joined encoded fields of one landed row, in positional order."""
    return "concat_ws(chr(9), " + ", ".join(
        encode_sql(values.get(f, "cast(null as string)")) for f in SOURCE_FIELDS[source]) + ")"


def header_line(source: str) -> str:
    return "\t".join(SOURCE_FIELDS[source])


def write_landing(rows: DataFrame, root: str, source: str, header: Column | None = None) -> str:
    """rows: market, bucket, seq, line.  ``header`` is each bucket's header line,
    by default the layout's.  Returns the source folder written."""
    header = (rows.select("market", "bucket").distinct()
              .select("market", "bucket", F.lit(-1).cast("long").alias("seq"),
                      (F.lit(header_line(source)) if header is None else header).alias("line")))
    out = f"{root.rstrip('/')}/{SOURCE_FOLDERS[source]}"
    (rows.select("market", "bucket", F.col("seq").cast("long"), "line").unionByName(header)
     .repartition("market", "bucket")
     .sortWithinPartitions("market", "bucket", "seq")
     .select("market", "bucket", "line")
     .write.mode("overwrite").partitionBy("market", "bucket").text(out))
    return out
