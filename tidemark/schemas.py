"""Fixed schemas of the control tables and the reports.

Instants are ``timestamp_ntz`` holding UTC wall time end to end; local text
is converted at the edges (``tidemark.functions.timeexpr``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Load strategies and queue / history states.
STRATEGIES = ("TPT", "WriteNOS", "JDBC")
DIRECT = "JDBC"
STAGED = "WriteNOS"
QUEUED, RUNNING_FLAG = "Q", "R"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
DEFAULT_CUTOFF = 200_000  # pending rows at or above the mark: direct below, staged at or above
DEFAULT_ZONE = "America/Phoenix"

NTZ = T.TimestampNTZType()

QUEUE = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("where_clause", T.StringType()),
    T.StructField("primary_key", T.StringType()),
    T.StructField("event_time", NTZ),
    T.StructField("trigger_time", NTZ),
    T.StructField("strategy", T.StringType()),
    T.StructField("lock_rows", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("event_time_latest", NTZ),
])
QUEUE_COLUMNS = [f.name for f in QUEUE.fields]

HISTORY = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("where_clause", T.StringType()),
    T.StructField("primary_key", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_time", NTZ),
    T.StructField("trigger_time", NTZ),
    T.StructField("finish_time", NTZ),
    T.StructField("duration_min", T.DoubleType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("lock_rows", T.BooleanType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("num_records", T.LongType()),
])
HISTORY_COLUMNS = [f.name for f in HISTORY.fields]
HISTORY_KEY = ["source_table", "event_time"]

ATTRS = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("ingestion_strategy", T.StringType()),
    T.StructField("cdc_watermark", T.StringType()),
    T.StructField("primary_key", T.StringType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("disabled", T.BooleanType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("min_staleness", T.IntegerType()),
    T.StructField("max_staleness", T.IntegerType()),
])
ATTRS_COLUMNS = [f.name for f in ATTRS.fields]

FEED = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("event_time", NTZ),
])

REPORT = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start", NTZ),
    T.StructField("end", NTZ),
    T.StructField("num_records", T.LongType()),
    T.StructField("error", T.StringType()),
])

# Batch enqueue columns: the two required ones, and all that may be given.
BATCH_REQUIRED = frozenset({"source_table", "strategy"})
BATCH_ALLOWED = frozenset({
    "source_table", "strategy", "target_table", "where_clause", "primary_key",
    "event_time", "lock_rows", "priority",
})


def empty(spark, schema: T.StructType):
    """An empty control table of the given schema."""
    return spark.createDataFrame([], schema)
