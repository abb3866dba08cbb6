"""Bursts of events per table: state with event-time timers that close a quiet table.

A burst is a run of a table's events with gaps of at most ``quiet``. Late and
out-of-order events may open, lengthen or join bursts as long as the watermark
allows, so the state of a table is its open bursts. A timer per burst fires
when the watermark passes its end by ``quiet``: no event that counts can join it
any more, so it is emitted, its state goes, and a table without open bursts
keeps none. State is bounded by the tables with events since the watermark less ``quiet``. (Spark offers a
time-to-live for processing time only; here the timers are what ends state.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.timeexpr import event_instant
from tidemark.schemas import NTZ
from tidemark.streaming.enqueue import publish_version

BURST = T.StructType([T.StructField("source_table", T.StringType()), T.StructField("first_event_time", NTZ),
                      T.StructField("latest_event_time", NTZ), T.StructField("events", T.LongType())])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ZERO = dt.datetime(1970, 1, 1)


def _micros(t: dt.datetime) -> int:
    return (t - _ZERO) // dt.timedelta(microseconds=1)


def _instant(micros: int) -> dt.datetime:
    return _ZERO + dt.timedelta(microseconds=micros)


def join_bursts(bursts: list[tuple[int, int, int]], events: list[int], quiet: int) -> list[tuple[int, int, int]]:
    """Open bursts ``(first, latest, events)`` with more events: neighbours no further apart than ``quiet`` are one."""
    out: list[tuple[int, int, int]] = []
    for first, latest, n in sorted([*bursts, *((t, t, 1) for t in events)]):
        if out and first - out[-1][1] <= quiet:
            out[-1] = (out[-1][0], max(out[-1][1], latest), out[-1][2] + n)
        else:
            out.append((first, latest, n))
    return out


class QuietTables(StatefulProcessor):
    """Emits a table's bursts when they are over."""

    def __init__(self, quiet_micros: int) -> None:
        self.quiet = quiet_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = T.StructType([T.StructField(c, T.LongType()) for c in ("first", "latest", "events")])
        self.open = handle.getListState("open", schema)

    def _end(self, latest: int) -> int:  # the first millisecond at which the burst is over
        return (latest + self.quiet) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = [tuple(b) for b in self.open.get()] if self.open.exists() else []
        after = join_bursts(before, [_micros(r["event_time"]) for r in rows], self.quiet)
        timers = {self._end(b[1]) for b in after}
        for t in {self._end(b[1]) for b in before} - timers:
            self.handle.deleteTimer(t)
        for t in timers - {self._end(b[1]) for b in before}:
            self.handle.registerTimer(t)
        self.open.put(after)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        held = [tuple(b) for b in self.open.get()] if self.open.exists() else []
        left = [b for b in held if self._end(b[1]) > now]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        return iter([Row(source_table=key[0], first_event_time=_instant(f), latest_event_time=_instant(t), events=n)
                     for f, t, n in held if self._end(t) <= now])

    def close(self) -> None:
        pass


class PublishBursts:
    """``foreachBatch`` body: the bursts that a micro-batch closed, as one version; nothing else is written."""

    def __init__(self, root: str) -> None:
        self.root = root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        publish_version(batch, self.root, batch_id)


def start_bursts(spark: SparkSession, feed_dir: str, feed_schema: T.StructType, root: str, checkpoint: str, *,
                 quiet: dt.timedelta, delay: str, files_per_batch: int | None = None, available_now: bool = True, interval: str = "60 seconds"):
    """Start the stream of closed bursts (``BURST`` rows in versions below ``root``).

    ``delay`` is the watermark: later events are dropped by Spark. The session
    needs the RocksDB state store, which is set here. Each version holds the
    bursts of one micro-batch only.
    """
    spark.conf.set(PROVIDER, ROCKSDB)
    reader = spark.readStream.schema(feed_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    feed = reader.parquet(feed_dir).select("source_table", "event_time").where("source_table is not null")
    processor = QuietTables(quiet // dt.timedelta(microseconds=1))
    timed = feed.withColumn("at", event_instant(F.col("event_time"))).withWatermark("at", delay)
    bursts = (timed.groupBy("source_table")
              .transformWithState(processor, BURST, "Append", "EventTime"))
    writer = bursts.writeStream.outputMode("append").foreachBatch(PublishBursts(root)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_bursts(spark: SparkSession, root: str) -> DataFrame:
    """All bursts closed so far."""
    return spark.read.schema(BURST).parquet(root).select(*BURST.fieldNames())


def state_rows(query) -> int:
    """State rows after a query's last micro-batch."""
    progress = query.lastProgress
    return sum(op["numRowsTotal"] for op in progress["stateOperators"]) if progress else 0


def still_open(feed: DataFrame, watermark, quiet: dt.timedelta) -> DataFrame:
    """Tables whose last event is not yet ``quiet`` before a watermark: those that keep state."""
    return feed.groupBy("source_table").agg(F.max("event_time").alias("latest")).where(
        F.col("latest") + F.lit(quiet) >= F.lit(watermark).cast(NTZ))
