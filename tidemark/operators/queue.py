"""Queue and history state transitions as pure DataFrame functions.

Each function returns the next state of a control table; a sink publishes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeexpr import is_valid_text, ntz, parse_local_text
from tidemark.operators.loading import duplicate_keys
from tidemark.schemas import (BATCH_ALLOWED, BATCH_REQUIRED, HISTORY_COLUMNS, HISTORY_KEY, QUEUE_COLUMNS,
                              QUEUED, RUNNING, RUNNING_FLAG)


def _instant(v) -> Column:
    return v if isinstance(v, Column) else ntz(v)


# ---------------------------------------------------------------- enqueue
def queue_upsert(queue: DataFrame, records: DataFrame) -> DataFrame:
    """MERGE records into the queue.

    Match: same source_table and the queue row is still 'Q'. Matched rows take
    the record's priority and the latest event time known (a late record never
    moves it back); unmatched records are
    inserted; all other queue rows (running ones included) stay as they are.
    ``records`` must hold one row per table (``enqueue_from_feed`` does).
    """
    t = queue.select(*[F.col(c).alias(f"t_{c}") for c in QUEUE_COLUMNS], F.lit(True).alias("_tm_t"))
    s = records.select(*[F.col(c).alias(f"s_{c}") for c in QUEUE_COLUMNS], F.lit(True).alias("_tm_s"))
    cond = (t.t_source_table == s.s_source_table) & (t.t_status == F.lit(QUEUED))
    j = t.join(s, cond, "full_outer")
    in_t = F.col("_tm_t").isNotNull()
    matched = in_t & F.col("_tm_s").isNotNull()
    updates = {
        "priority": F.col("s_priority"),
        "event_time_latest": F.greatest("t_event_time_latest", "t_event_time",
                                        F.coalesce(F.col("s_event_time_latest"), F.col("s_event_time"))),
    }
    cols = []
    for c in QUEUE_COLUMNS:
        keep = F.col(f"t_{c}")
        if c in updates:
            keep = F.when(matched, updates[c]).otherwise(keep)
        cols.append(F.when(in_t, keep).otherwise(F.col(f"s_{c}")).alias(c))
    return j.select(*cols)


def prepare_batch(frame: DataFrame, catalog: str, as_of, local_zone: str | None = None) -> DataFrame:
    """Check the columns of a batch-enqueue frame and fill defaults.

    source_table and strategy are required; only the 8 queue input columns are
    allowed. Missing or null optional values get: target = catalog.source,
    where '', primary key '', event_time = as_of, lock_rows true, priority 1.
    Text event times are parsed strictly (``yyyy-MM-dd HH:mm:ss``), as local
    time in ``local_zone`` when given, else as UTC; text that does not parse is
    an error when the rows are read.
    """
    cols = set(frame.columns)
    missing = BATCH_REQUIRED - cols
    if missing:
        raise ValueError(f"required column(s) {sorted(missing)} not found, only: {frame.columns}")
    extra = cols - BATCH_ALLOWED
    if extra:
        raise ValueError(f"column(s) {sorted(extra)} not allowed; allowed: {sorted(BATCH_ALLOWED)}")
    types = {"target_table": "string", "where_clause": "string", "primary_key": "string",
             "event_time": "timestamp_ntz", "lock_rows": "boolean", "priority": "int"}
    if "event_time" in cols and isinstance(frame.schema["event_time"].dataType, T.StringType):
        text = F.col("event_time")
        parsed = (parse_local_text(text, local_zone) if local_zone
                  else F.when(is_valid_text(text), text.try_cast("timestamp_ntz")))
        wrong = F.raise_error(F.concat(F.lit("not an event time: "), text)).cast("timestamp_ntz")
        frame = frame.withColumn("event_time", F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(wrong))
    for c, t in types.items():
        frame = frame.withColumn(c, F.col(c).cast(t) if c in cols else F.lit(None).cast(t))
    return frame.select(
        "source_table",
        F.coalesce("target_table", F.concat(F.lit(f"{catalog}."), F.col("source_table"))).alias("target_table"),
        F.coalesce("where_clause", F.lit("")).alias("where_clause"),
        F.coalesce("primary_key", F.lit("")).alias("primary_key"),
        F.coalesce(F.col("event_time"), _instant(as_of)).alias("event_time"),
        "strategy",
        F.coalesce("lock_rows", F.lit(True)).alias("lock_rows"),
        F.lit(QUEUED).alias("status"),
        F.coalesce("priority", F.lit(1)).alias("priority"),
    )


def queue_batch_upsert(queue: DataFrame, frame: DataFrame, catalog: str, as_of,
                       local_zone: str | None = None) -> DataFrame:
    """Batch MERGE on source_table only: matched rows (running ones too) are overwritten
    and become 'Q'; trigger_time and event_time_latest are kept; others inserted."""
    s = prepare_batch(frame, catalog, as_of, local_zone)
    if not duplicate_keys(frame, "source_table").isEmpty():
        raise ValueError("the batch holds a source_table more than once")
    payload = [c for c in s.columns if c != "source_table"]
    t = queue.select(*[F.col(c).alias(f"t_{c}") for c in QUEUE_COLUMNS], F.lit(True).alias("_tm_t"))
    s = s.select(F.col("source_table").alias("s_source_table"), *[F.col(c).alias(f"s_{c}") for c in payload],
                 F.lit(True).alias("_tm_s"))
    j = t.join(s, t.t_source_table == s.s_source_table, "full_outer")
    in_s = F.col("_tm_s").isNotNull()
    cols = []
    for c in QUEUE_COLUMNS:
        if c == "source_table":
            cols.append(F.coalesce("t_source_table", "s_source_table").alias(c))
        elif c in payload:
            cols.append(F.when(in_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        else:  # trigger_time, event_time_latest: kept (null for new rows)
            cols.append(F.col(f"t_{c}").alias(c))
    return j.select(*cols)


# ---------------------------------------------------------------- claim
def _claim_keys(claims: DataFrame, flag: str) -> DataFrame:
    return claims.select(*HISTORY_KEY, F.lit(True).alias(flag)).dropDuplicates(HISTORY_KEY)


def queue_after_claim(queue: DataFrame, claims: DataFrame, as_of) -> DataFrame:
    """Claimed (source_table, event_time) rows become 'R' with trigger_time = as_of."""
    j = queue.join(_claim_keys(claims, "_tm_c"), HISTORY_KEY, "left")
    hit = F.coalesce(F.col("_tm_c"), F.lit(False))
    return j.select(*[
        F.when(hit, F.lit(RUNNING_FLAG)).otherwise(F.col(c)).alias(c) if c == "status"
        else F.when(hit, _instant(as_of)).otherwise(F.col(c)).alias(c) if c == "trigger_time"
        else F.col(c)
        for c in QUEUE_COLUMNS
    ])


def history_after_claim(history: DataFrame, claims: DataFrame, as_of) -> DataFrame:
    """History after claims: absent -> RUNNING row inserted; finished (SUCCESS/FAILED)
    -> replaced by a RUNNING row; already RUNNING -> untouched."""
    h = history.join(_claim_keys(claims, "_tm_c"), HISTORY_KEY, "left")
    hit = F.coalesce(F.col("_tm_c"), F.lit(False))
    kept = h.where(~hit | (F.col("status") == RUNNING)).select(*HISTORY_COLUMNS)
    still_running = h.where(hit & (F.col("status") == RUNNING)).select(*HISTORY_KEY)
    fresh = claims.join(still_running, HISTORY_KEY, "left_anti").select(
        "source_table", "target_table", "where_clause", "primary_key", F.lit(RUNNING).alias("status"),
        "event_time", _instant(as_of).alias("trigger_time"), F.lit(None).cast("timestamp_ntz").alias("finish_time"),
        F.lit(None).cast("double").alias("duration_min"), "strategy", "lock_rows",
        F.col("priority").cast("int").alias("priority"), F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("bigint").alias("num_records"),
    )
    return kept.unionByName(fresh)


# ---------------------------------------------------------------- complete
def queue_after_complete(queue: DataFrame, completions: DataFrame) -> DataFrame:
    """Delete the running queue rows whose (source_table, event_time) completed."""
    c = completions.select(*HISTORY_KEY, F.lit(True).alias("_tm_done")).dropDuplicates(HISTORY_KEY)
    j = queue.join(c, HISTORY_KEY, "left")
    gone = F.coalesce(F.col("_tm_done"), F.lit(False)) & (F.col("status") == RUNNING_FLAG)
    return j.where(~gone).select(*QUEUE_COLUMNS)


def history_after_complete(history: DataFrame, completions: DataFrame) -> DataFrame:
    """Set status, finish_time, duration_min, num_records and error (quotes removed) by key."""
    sets = ["status", "finish_time", "duration_min", "num_records", "error"]
    last = F.max_by(F.struct(*sets), F.coalesce(F.col("finish_time").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")))
    c = (completions.groupBy(*HISTORY_KEY).agg(last.alias("_tm_last"))  # of repeated completions the last counts
         .select(*HISTORY_KEY, *[F.col(f"_tm_last.{x}").alias(f"_c_{x}") for x in sets], F.lit(True).alias("_tm_done")))
    j = history.join(c, HISTORY_KEY, "left")
    hit = F.coalesce(F.col("_tm_done"), F.lit(False))
    new = {
        "status": F.col("_c_status"),
        "finish_time": F.col("_c_finish_time").cast("timestamp_ntz"),
        "duration_min": F.col("_c_duration_min").cast("double"),
        "num_records": F.col("_c_num_records").cast("bigint"),
        "error": F.regexp_replace(F.col("_c_error"), "'", ""),
    }
    return j.select(*[F.when(hit, new[x]).otherwise(F.col(x)).alias(x) if x in new else F.col(x)
                      for x in HISTORY_COLUMNS])


# ---------------------------------------------------------------- requeue / reset / checks
def requeue_running_queue(queue: DataFrame) -> DataFrame:
    """Every running row goes back to 'Q'."""
    return queue.withColumn("status", F.when(F.col("status") == RUNNING_FLAG, F.lit(QUEUED))
                            .otherwise(F.col("status")))


def requeue_running_history(history: DataFrame, queue: DataFrame) -> DataFrame:
    """Delete history rows of the running queue keys, whatever their status."""
    running = queue.where(F.col("status") == RUNNING_FLAG).select(*HISTORY_KEY)
    return history.join(running, HISTORY_KEY, "left_anti")


def queue_reset(queue: DataFrame) -> DataFrame:
    """The empty queue (same schema)."""
    return queue.limit(0)


def queued_records(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("status") == QUEUED)


def queue_length(queue: DataFrame) -> DataFrame:
    """One row: number of queued ('Q') rows."""
    return queue.agg(F.count(F.when(F.col("status") == QUEUED, 1)).alias("queued"))


def queue_key_check(queue: DataFrame) -> DataFrame:
    """Tables breaking the invariant of at most one 'Q' and one 'R' row each."""
    g = queue.groupBy("source_table").agg(
        F.count(F.when(F.col("status") == QUEUED, 1)).alias("queued"),
        F.count(F.when(F.col("status") == RUNNING_FLAG, 1)).alias("running"),
    )
    return g.where((F.col("queued") > 1) | (F.col("running") > 1))


def resume_watermark(queue: DataFrame, history: DataFrame, start=None) -> DataFrame:
    """One row: the feed mark to resume from (latest known event), else ``start``."""
    q = queue.agg(F.max(F.coalesce("event_time_latest", "event_time")).alias("et"))
    h = history.agg(F.max("event_time").alias("et"))
    mark = q.unionByName(h).agg(F.max("et").alias("watermark"))
    if start is not None:
        mark = mark.select(F.coalesce(F.col("watermark"), _instant(start)).alias("watermark"))
    return mark
