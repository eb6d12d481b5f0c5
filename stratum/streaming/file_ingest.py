"""Continuous file ingest (S12): new landed files -> bronze, each file once.

A ``readStream`` text source lists the landing folder; the checkpoint
records which files were processed, so every file is loaded exactly once
across runs (``availableNow`` drains the backlog and stops, like a
scheduled pipe).  Each micro-batch holds whole files, so the batch ingest
functions (line numbering, record assembly, parsing) apply unchanged inside
``foreachBatch``.  Every batch writes to its own ``batch=<id>`` folder with
overwrite, so a replayed batch after a failure rewrites the same output
instead of appending duplicates.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import ingest, layers
from ..sources.schemas import SOURCE_FOLDERS


def stream_lines(spark: SparkSession, root: str, source: str, max_files_per_trigger: int | None = None):
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (reader.load(f"{root.rstrip('/')}/{SOURCE_FOLDERS[source]}")
            .select(F.col("value"), F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_block_start").alias("block_start")))


def load_batch(batch: DataFrame, batch_id: int, root: str, source: str, out: str, load_ts=None) -> None:
    """Bronze raw + parsed + issues of one micro-batch (idempotent).

    The batch's lines are written once to the shared folder; raw and parsed
    rows come from there, the raw ones while the records are being assembled.
    Parsed rows keep the parser's verdict, so the issues are a filter of them
    and no row is parsed twice.  The batch is read from its commit mark on.
    """
    spark, base = batch.sparkSession, out.rstrip("/")
    ts, others = ingest._ts(load_ts), []

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    with ThreadPoolExecutor(max_workers=3) as pool:
        def put_raw(lines: DataFrame) -> None:
            others.append(pool.submit(put, "raw", ingest.raw_rows(lines, "value", ts.alias("load_timestamp"))))
        landed = ingest.land_lines(batch.withColumn("_id", F.monotonically_increasing_id()), root, True, put_raw)
        others.append(pool.submit(put, "file_issues", landed.file_issues))
        put("parse_issues", ingest.parse_issues(put("parsed", ingest.to_parsed(landed, source, ts, keep_corrupt=True))))
        for o in others:
            o.result()
    layers.mark(spark, f"{base}/_commits/batch={batch_id}")


def stream_bronze(spark: SparkSession, root: str, source: str, out: str, checkpoint: str,
                  load_ts=None, available_now: bool = True,
                  processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream; call ``awaitTermination()`` on the result."""
    lines = stream_lines(spark, root, source, max_files_per_trigger)
    writer = (lines.writeStream
              .foreachBatch(lambda df, bid: load_batch(df, bid, root, source, out, load_ts))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_bronze(spark: SparkSession, out: str, name: str) -> DataFrame:
    """All committed batches of one streamed bronze table (the batch folder
    and the parser's verdict are dropped); a batch that is being written, or
    failed, isn't read."""
    base = out.rstrip("/")
    batches = [m for m in layers.marks(spark, f"{base}/_commits") if m.startswith("batch=")]
    if not batches:
        raise FileNotFoundError(f"no committed batch in {base}")
    path = f"{base}/{name}"
    return spark.read.option("basePath", path).parquet(*[f"{path}/{b}" for b in batches]).drop("batch", "_corrupt")
