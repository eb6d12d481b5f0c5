"""Deliveries watched against their deadlines (S12, Q12 as a stateful stream).

The stream carries two kinds of rows: ``due`` rows announce that a source and
market must deliver for a period by a deadline, ``file`` rows are deliveries.
One state per source, market and period keeps the first delivery seen.  Event
time timers decide: when the watermark passes the deadline, no delivery up to
it can come any more, so a pair without one is reported as missed; when the
watermark passes the period's end, a missed pair is reported as late, with its
first delivery, or as absent, and its state is dropped.  The rows depend on
the event times alone, not on the order or the batches in which files arrive,
as long as they are no later than the watermark's delay; what comes later
than that is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["source_name", "market", "period"]
#: Rows of the stream: kind is "due" or "file"; at is the event time; due and
#: period_end are set in "due" rows.
INPUT_SCHEMA = "kind string, source_name string, market string, period string, at timestamp, due timestamp, period_end timestamp"
OUTPUT_SCHEMA = "source_name string, market string, period string, status string, due timestamp, delivered_at timestamp"
_REPORT = "source_name string, market string, period string, status string, due_ms long, first_ms long"

# What is reported.
MISSED, LATE, ABSENT = "missed", "late", "absent"


class DeadlineWatch(StatefulProcessor):
    """First delivery and deadline of one source, market and period, in
    milliseconds of event time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "at long")
        self.due = handle.getValueState("due", "due long, period_end long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = self.first.get()[0] if self.first.exists() else None
        for part in rows:
            files = part[part["kind"] == "file"]
            if len(files):
                at = int(files["at_ms"].min())
                first = at if first is None else min(first, at)
            for row in part[part["kind"] == "due"].itertuples():
                if not self.due.exists():  # announced again: the first announcement holds
                    due, end = int(row.due_ms), int(row.end_ms)
                    self.due.update((due, end))
                    self.handle.registerTimer(due)
                    self.handle.registerTimer(max(end, due + 1))
        if first is not None:
            self.first.update((first,))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, _ = self.due.get()
        first = self.first.get()[0] if self.first.exists() else None
        if expiredTimerInfo.getExpiryTimeInMs() == due:
            if first is None or first > due:
                yield self._report(key, MISSED, due, None)
            return
        if first is None:
            yield self._report(key, ABSENT, due, None)
        elif first > due:
            yield self._report(key, LATE, due, first)
        self.first.clear()
        self.due.clear()

    def _report(self, key, status: str, due: int, delivered: int | None) -> pd.DataFrame:
        return pd.DataFrame({"source_name": [key[0]], "market": [key[1]], "period": [key[2]], "status": [status], "due_ms": [due],
                             "first_ms": pd.array([delivered], "Int64")})

    def close(self) -> None:
        pass


def watch(rows: DataFrame, delay: str) -> DataFrame:
    """Reports of a stream of INPUT_SCHEMA rows that come at most ``delay``
    late.  State lives in RocksDB, one entry per open period, so it grows with
    the sources and markets that are due, not with the files delivered; the
    query has to be started with PROVIDER set to ROCKSDB."""
    millis = [F.unix_millis(c).alias(n) for c, n in (("at", "at_ms"), ("due", "due_ms"), ("period_end", "end_ms"))]
    reports = rows.withWatermark("at", delay).select("kind", *KEYS, "at", *millis).groupBy(*KEYS).transformWithStateInPandas(
        DeadlineWatch(), outputStructType=_REPORT, outputMode="Append", timeMode="EventTime")
    return reports.select(*KEYS, "status", F.timestamp_millis("due_ms").alias("due"), F.timestamp_millis("first_ms").alias("delivered_at"))


def watch_folder(spark: SparkSession, folder: str, out: str, checkpoint: str, delay: str, files_per_trigger: int | None = 1) -> StreamingQuery:
    """Watch a folder of parquet files until what is there is read
    (availableNow); a later call goes on from the checkpoint."""
    reader = spark.readStream.schema(INPUT_SCHEMA)
    rows = (reader.option("maxFilesPerTrigger", str(files_per_trigger)) if files_per_trigger else reader).parquet(folder)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # a query keeps the settings it was started with
    try:
        return (watch(rows, delay).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start(out))
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
