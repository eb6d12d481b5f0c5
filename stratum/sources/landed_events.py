"""Landing files derived from ``events`` (matching-shaped rows).

Some values carry a quote, a tab and a newline (one record on two lines),
some a quote inside or at their start, some are the NULL token.  ``stray``
rows end with a field that opens and never ends; they are used for the
file and parse issues only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import landing, standins
from .schemas import MATCHING_FIELDS

VALUES = dict(standins._MATCHING)
VALUES["merged_chain_name"] = ("case when event_id % 10 = 0 then concat('chain \"', event_type, '\"', chr(9), "
                               "'x', chr(10), 'y') when event_id % 10 = 5 then concat('size 12\" ', event_type) "
                               "when event_id % 10 = 7 then concat('\"', event_type) else concat('chain-', cast(user_id % 10 as string)) end")
VALUES["sd"] = "case when event_id % 17 = 0 then 'NULL' else cast(event_id % 12 as string) end"

# Eight files a market for every 400,000 events.
BUCKET = "cast(floor(event_id / 400000) as bigint) * 8 + event_id % 8"

# The last row of a third of the files opens a field more that never ends.
STRAY = ("(event_id % 8 % 3 = 0 and event_id % 10 <> 0 and "
         f"row_number() over (partition by r_name, {BUCKET} order by event_id desc) = 1)")

ROWS_SQL = (f"select upper(r_name) as market, {BUCKET} as bucket, event_id as seq, event_id, "
            + landing.line_sql("matching", VALUES) + " as line, "
            + ", ".join(f"{VALUES[f]} as {f}" for f in VALUES)
            + f", {STRAY} as stray from {{events}} join {{region}} on r_regionkey = user_id % 5")

# Fixed value: load time of the registered ingest runs.
INGEST_LOAD_TS = "2024-06-03 00:00:00"


def landing_rows(spark: SparkSession, sf_dir: str, with_stray: bool = False) -> DataFrame:
    rows = spark.sql(ROWS_SQL, events=standins.read_table(spark, sf_dir, "events"),
                     region=standins.read_table(spark, sf_dir, "region"))
    if with_stray:
        rows = rows.withColumn("line", F.concat("line", F.when(F.col("stray"), F.lit('\t"')).otherwise(F.lit(""))))
    return rows.select("market", "bucket", "seq", "line")


# Headers of the buckets 1 to 4 of every eight: a column first that was last, one
# more, one less, some spelt otherwise.
DRIFTED = {
    1: (MATCHING_FIELDS[-1], *MATCHING_FIELDS[:-1]),
    2: (*MATCHING_FIELDS[:3], "reviewed_by", *MATCHING_FIELDS[3:]),
    3: tuple(f for f in MATCHING_FIELDS if f != "place_id"),
    4: tuple({"id_outlet": "Id Outlet", "similarity_score_name": "similarty_score_name", "sd": "quite_else_here"}.get(f, f) for f in MATCHING_FIELDS),
}
_COLUMN_OF = {"Id Outlet": "id_outlet", "similarty_score_name": "similarity_score_name", "quite_else_here": "sd"}


def _drifted_line(fields) -> str:
    """A line of encoded fields (``_<field>``) in the order of a header."""
    return "concat_ws(chr(9), " + ", ".join("'someone'" if f == "reviewed_by" else f"_{_COLUMN_OF.get(f, f)}" for f in fields) + ")"


def drifted_header() -> Column:
    header = F.lit(landing.header_line("matching"))
    for variant, fields in DRIFTED.items():
        header = F.when(F.col("bucket") % 8 == variant, F.lit("\t".join(fields))).otherwise(header)
    return header


def land_drifted(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The same rows in files whose headers drifted."""
    tables = {t: standins.read_table(spark, sf_dir, t) for t in ("events", "region")}
    encoded = ", ".join(f"{landing.encode_sql(f)} as _{f}" for f in MATCHING_FIELDS)
    line = "case bucket % 8 " + " ".join(f"when {v} then {_drifted_line(fields)}" for v, fields in DRIFTED.items()) + " else line end"
    rows = spark.sql(f"select market, bucket, seq, {line} as line from (select market, bucket, seq, line, {encoded} from ({ROWS_SQL}))", **tables)
    landing.write_landing(rows, root, "matching", drifted_header())
