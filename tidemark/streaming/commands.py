"""One command stream for the queue: feed rows, claims and completions, applied by one writer.

Whoever polls the feed, dispatches work or finishes a load only appends files.
The three folders are streaming sources of one query, united with their kind
and the state version they were decided on, and one ``foreachBatch`` body
applies them, so the queue has a single writer and every reader sees whole
versions. Claims and completions are applied first, oldest decision first; then
the feed is enqueued. A claim counts only if its row still waits and a
completion only if its row still runs: a row that two dispatchers claimed from
the same version is taken once, and a completion delivered twice ends nothing
that was claimed again meanwhile. Refused commands are kept with their reason.

A version has the queue, the mark (the latest feed instant applied, which
never moves back, also when completed tables leave the queue) and, if
it changed, the history. The queue's folder is written last: it commits the version, and a
replayed micro-batch writes the same version from the same predecessor.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeexpr import event_instant, ntz
from tidemark.operators import queue as qops
from tidemark.operators import ranking
from tidemark.operators.feed import enqueue_from_feed
from tidemark.schemas import FEED, HISTORY, HISTORY_KEY, NTZ, QUEUED, RUNNING_FLAG
from tidemark.sinks.tables import create_if_absent, discard, materialize
from tidemark.streaming.enqueue import (latest_version, previous_version, publish_version, published_versions,
                                        read_version, version_path)

CLAIM, COMPLETION, FEED_ROW, SEEN = "claim", "completion", "feed", "seen"

_ISSUED = [T.StructField("on_version", T.LongType()), T.StructField("as_of", NTZ)]
CLAIMS = T.StructType([*_ISSUED, *[HISTORY[c] for c in ("source_table", "event_time", "target_table", "where_clause",
                                                        "primary_key", "strategy", "lock_rows", "priority")],
                       T.StructField("worker", T.StringType())])
COMPLETIONS = T.StructType([*_ISSUED, *[HISTORY[c] for c in ("source_table", "event_time", "status", "finish_time",
                                                             "duration_min", "num_records", "error")]])
MARK = T.StructType([T.StructField("mark", NTZ)])
REFUSED = ["kind", "on_version", "as_of", *HISTORY_KEY, "reason"]


@dataclass(frozen=True)
class Folders:
    """Where commands arrive (``feed``, ``claims``, ``completions``) and the state is kept, below one root."""
    root: str

    def __getattr__(self, name: str) -> str:
        if name in ("feed", "claims", "completions", "queue", "history", "marks", "refused", "late", "checkpoint"):
            return f"{self.root.rstrip('/')}/{name}"
        raise AttributeError(name)

    def create(self, spark: SparkSession) -> None:
        """Empty command folders, so that a stream can start before the first command."""
        for path, schema in ((self.feed, FEED), (self.claims, CLAIMS), (self.completions, COMPLETIONS)):
            create_if_absent(spark, path, schema)


@dataclass
class State:
    version: int
    queue: DataFrame
    history: DataFrame
    mark: object  # the latest feed instant applied, or None


def read_state(spark: SparkSession, folders: Folders, version: int | None = None) -> State:
    """A published version (default: the latest)."""
    version = latest_version(spark, folders.queue) if version is None else version
    if version is None:
        raise ValueError(f"no published version under {folders.queue}")
    mark = read_version(spark, folders.marks, version).first()["mark"]
    return State(version, read_version(spark, folders.queue, version), _history(spark, folders, version + 1), mark)


def _history(spark: SparkSession, folders: Folders, below: int) -> DataFrame:
    """The history of the highest version below another (versions that change nothing write none)."""
    found = previous_version(spark, folders.history, below)
    return spark.createDataFrame([], HISTORY) if found is None else found


def publish_state(spark: SparkSession, folders: Folders, version: int, queue: DataFrame, history: DataFrame | None,
                  mark, refused: DataFrame | None = None) -> None:
    """Write a version; the queue last, which commits it."""
    if history is not None:
        publish_version(history, folders.history, version)
    publish_version(spark.createDataFrame([(mark,)], MARK), folders.marks, version)
    if refused is not None:
        publish_version(refused, folders.refused, version)
    publish_version(queue, folders.queue, version)


# ---------------------------------------------------------------- issuing commands
def issue_claims(spark: SparkSession, folders: Folders, attrs: DataFrame, as_of, slots: Mapping[str, int]) -> DataFrame:
    """Dispatch: claim the best waiting rows of the latest version and append them as commands.

    Returns the claims asked for; ``accepted_claims`` says which were granted.
    """
    state = read_state(spark, folders)
    best = ranking.claim_eligible(state.queue, attrs, as_of, slots)
    claims = best.withColumn("on_version", F.lit(state.version).cast("long")).withColumn("as_of", _instant(as_of))
    claims = materialize(claims.select(*[F.col(f.name).cast(f.dataType) for f in CLAIMS]), "claims")
    claims.write.mode("append").parquet(folders.claims)
    return claims


def issue_completions(spark: SparkSession, folders: Folders, completions: DataFrame, as_of) -> None:
    """Append finished loads as commands. They need the columns of ``COMPLETIONS`` but for the issue."""
    version = latest_version(spark, folders.queue)
    done = completions.withColumn("on_version", F.lit(version).cast("long")).withColumn("as_of", _instant(as_of))
    done.select(*[F.col(f.name).cast(f.dataType) for f in COMPLETIONS]).write.mode("append").parquet(folders.completions)


def accepted_claims(queue: DataFrame, claims: DataFrame) -> DataFrame:
    """The claims that ``queue`` shows as running since they were asked for."""
    running = queue.where(F.col("status") == RUNNING_FLAG).select(*HISTORY_KEY, F.col("trigger_time").alias("as_of"))
    return claims.join(running, [*HISTORY_KEY, "as_of"], "left_semi")


def _instant(v):
    return v if not isinstance(v, str) else F.lit(v).cast("timestamp_ntz")


# ---------------------------------------------------------------- applying commands
def apply_commands(queue: DataFrame, history: DataFrame, commands: DataFrame, attrs: DataFrame,
                   catalog: str, plan: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The next queue, the next history (None: unchanged) and the refused commands (None: none were given).

    ``commands`` (``command_rows``) must be stable between reads. Claims and
    completions are applied by the version and instant they were issued at, a
    step for each dispatch since the last batch; feed rows last.
    """
    issued = commands.where(F.col("kind").isin(CLAIM, COMPLETION))
    steps = issued.select("on_version", "as_of").distinct().orderBy("on_version", "as_of").collect()
    refused = None
    changed = bool(steps)
    for i, step in enumerate(steps):
        own = issued.where(F.col("on_version").eqNullSafe(F.lit(step["on_version"]).cast("long"))
                           & F.col("as_of").eqNullSafe(F.lit(step["as_of"]).cast(NTZ)))
        claims = own.where(F.col("kind") == CLAIM)
        done = own.where(F.col("kind") == COMPLETION)
        # the first of equal claims, by all it says, so that a replay takes the same
        first = claims.groupBy(*HISTORY_KEY).agg(F.min(F.struct(*[f.name for f in CLAIMS if f.name not in HISTORY_KEY]))
                                                 .alias("c"), F.count("*").alias("copies"))
        waiting = queue.where(F.col("status") == QUEUED).select(*HISTORY_KEY, F.lit(True).alias("open")).distinct()
        running = queue.where(F.col("status") == RUNNING_FLAG).select(*HISTORY_KEY, F.lit(True).alias("open")).distinct()
        judged = materialize(first.join(waiting, HISTORY_KEY, "left").select(*HISTORY_KEY, "c.*", "copies", "open"), "claims")
        ended = materialize(done.join(running, HISTORY_KEY, "left"), "completions")
        granted, over = judged.where("open"), ended.where("open")
        queue = qops.queue_after_complete(qops.queue_after_claim(queue, granted, F.lit(step["as_of"]).cast(NTZ)), over)
        history = qops.history_after_claim(history, granted, F.lit(step["as_of"]).cast(NTZ))
        history = qops.history_after_complete(history, over)
        if i + 1 < len(steps):  # one step's plan at a time
            queue, history = materialize(queue, "queue"), materialize(history, "history")
        no = (judged.where("open is null").withColumn("kind", F.lit(CLAIM)).withColumn("reason", F.lit("row does not wait"))
              .select(*REFUSED)
              .unionByName(judged.where("copies > 1").withColumn("kind", F.lit(CLAIM))
                           .withColumn("reason", F.lit("claimed more than once")).select(*REFUSED))
              .unionByName(ended.where("open is null").withColumn("reason", F.lit("row does not run")).select(*REFUSED)))
        refused = no if refused is None else refused.unionByName(no)
    feed = commands.where(F.col("kind") == FEED_ROW).select("source_table", "event_time")
    queue = qops.queue_upsert(queue, enqueue_from_feed(feed, attrs, catalog, plan))
    return queue, history if changed else None, refused


def command_rows(spark: SparkSession, folders: Folders, files_per_batch: int | None = None,
                 delay: str | None = None) -> DataFrame:
    """The three folders as one stream of commands; ``modified`` is the time of a row's file.

    With a ``delay`` a feed row delivered again is dropped while Spark's state
    remembers it, which is for that long after the latest instant; every row is also passed on as
    ``seen``, for the rows that come later than that.
    """
    def read(path: str, schema: T.StructType, kind: str) -> DataFrame:
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(path).select(F.lit(kind).alias("kind"), *schema.fieldNames(),
                                           F.col("_metadata.file_modification_time").alias("modified"))

    feed = read(folders.feed, FEED, FEED_ROW)
    if delay:
        once = (feed.withColumn("at", event_instant(F.col("event_time"))).withWatermark("at", delay)
                .dropDuplicatesWithinWatermark(["source_table", "event_time"]).drop("at"))
        feed = once.unionByName(read(folders.feed, FEED, SEEN))
    return (feed.unionByName(read(folders.claims, CLAIMS, CLAIM), allowMissingColumns=True)
            .unionByName(read(folders.completions, COMPLETIONS, COMPLETION), allowMissingColumns=True))


class ApplyBatch:
    """``foreachBatch`` body. ``attrs`` is called for every batch, so that it sees the settings of the day."""

    def __init__(self, folders: Folders, attrs: Callable[[], DataFrame], catalog: str, first: int, skip_through, since,
                 plan: Callable[[], DataFrame] | None = None, keep_versions: int | None = None, delay: str | None = None):
        self.delay = delay
        self.folders, self.attrs, self.catalog, self.first = folders, attrs, catalog, first
        self.skip_through, self.since = skip_through, since
        self.plan, self.keep_versions = plan, keep_versions

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = self.first + batch_id
        before = latest_version(spark, self.folders.queue, below=version)
        if before is None:
            raise ValueError(f"no version to build batch {batch_id} on under {self.folders.queue}")
        state = read_state(spark, self.folders, before)
        if self.skip_through is not None:  # files that an earlier checkpoint has read
            read = (F.col("kind").isin(FEED_ROW, SEEN) & (F.col("modified") <= F.lit(self.since))
                    & (F.col("event_time") <= ntz(self.skip_through)))
            batch = batch.where(~F.coalesce(read, F.lit(False)))
        commands = materialize(batch.drop("modified"), "commands")
        if self.delay is not None:  # later than the delay after the mark: kept aside, whether Spark dropped it or not
            limit = F.lit(state.mark).cast(NTZ) - F.expr(f"INTERVAL {self.delay}")
            late = F.coalesce(F.col("event_time") <= limit, F.lit(False))
            publish_version(commands.where((F.col("kind") == SEEN) & late).select("source_table", "event_time"),
                            self.folders.late, version)
            commands = commands.where((F.col("kind") != SEEN) & ~((F.col("kind") == FEED_ROW) & late))
        queue, history, refused = apply_commands(state.queue, state.history, commands, self.attrs(), self.catalog,
                                                 self.plan() if self.plan else None)
        latest = commands.where(F.col("kind") == FEED_ROW).agg(F.max("event_time").alias("m")).first()["m"]
        mark = max((m for m in (state.mark, latest) if m is not None), default=None)
        publish_state(spark, self.folders, version, queue, history, mark, refused)
        if self.keep_versions:
            drop_old_versions(spark, self.folders, self.keep_versions)


def read_late(spark: SparkSession, folders: Folders) -> DataFrame:
    """Feed rows that came too late to be enqueued, with the version they came in."""
    return spark.read.parquet(folders.late)


def drop_old_versions(spark: SparkSession, folders: Folders, keep: int) -> None:
    """Delete all but the last ``keep`` versions, and histories that no kept version needs."""
    versions = published_versions(spark, folders.queue)
    if len(versions) <= keep:
        return
    oldest = versions[-keep]
    gone = [version_path(root, v) for root in (folders.queue, folders.marks, folders.refused)
            for v in published_versions(spark, root) if v < oldest]
    needed = max((v for v in published_versions(spark, folders.history) if v <= oldest), default=None)
    gone += [version_path(folders.history, v) for v in published_versions(spark, folders.history)
             if needed is not None and v < needed]
    discard(spark, gone)


def _first_start(spark: SparkSession, folders: Folders, checkpoint: str) -> tuple[int, object, object]:
    """The version of a checkpoint's batch 0, and up to where and when the feed was read before it.

    Written beside the checkpoint at its first start, so restarts find the same.
    """
    note = f"{checkpoint.rstrip('/')}.first"
    if latest_version(spark, note) is None:
        state = read_state(spark, folders)
        row = spark.range(1).select(F.lit(state.version + 1).cast("long").alias("first"),
                                    F.lit(state.mark).cast(NTZ).alias("mark"), F.current_timestamp().alias("since"),
                                    F.lit(latest_version(spark, folders.queue) > -1).alias("again"))
        publish_version(row, note, 0)
    found = read_version(spark, note, 0).first()
    return found["first"], found["mark"] if found["again"] else None, found["since"]


def start_commands(spark: SparkSession, folders: Folders, attrs: DataFrame | Callable[[], DataFrame], catalog: str, *,
                   initial: tuple[DataFrame, DataFrame] | None = None, checkpoint: str | None = None,
                   plan: Callable[[], DataFrame] | None = None, files_per_batch: int | None = None,
                   delay: str | None = None, keep_versions: int | None = None, available_now: bool = True,
                   interval: str = "60 seconds"):
    """Start the command stream; one at a time may run on a root.

    ``initial`` (queue, history) seeds version -1. ``attrs`` may be a function
    that reads the current attributes for each batch; ``plan`` likewise gives
    load plans. A new ``checkpoint`` over an existing state goes on with its versions and does not
    read again what the mark covers: rows up to the mark in feed files older
    than its first start. Claims and completions that it reads again are refused.
    """
    folders.create(spark)
    if initial is not None and latest_version(spark, folders.queue) is None:
        queue, history = initial
        known = queue.agg(F.max(F.coalesce("event_time_latest", "event_time")).alias("m")).first()["m"]
        publish_state(spark, folders, -1, queue, history, known)
    checkpoint = checkpoint or folders.checkpoint
    first, mark, since = _first_start(spark, folders, checkpoint)
    body = ApplyBatch(folders, attrs if callable(attrs) else lambda: attrs, catalog, first, mark, since, plan, keep_versions, delay)
    writer = (command_rows(spark, folders, files_per_batch, delay).writeStream.foreachBatch(body)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
