"""Control-table inputs derived from the test tables (FIXTURES.md section 3).

Everything is a lazy DataFrame over the parquet files, so the work grows with
the tables. Time literals are ``timestamp_ntz``; no session zone is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeexpr import ntz, seconds_between
from tidemark.sinks.tables import materialize

# The cycle boundaries used by every fixture and query.
QUEUE_FROM = "2024-01-18 00:00:00"
CYCLE_START = "2024-01-20 00:00:00"
CYCLE_END = "2024-01-21 00:00:00"
RANK_AS_OF = "2024-01-19 00:00:00"
TARGET_CUTOFF = "2000-01-01 00:00:00"
COMPLETE_AS_OF = "2024-01-20 00:45:30"
FAILED_ERROR = "load failed: can't reach source"
CATALOG = "main"
SLOTS = {"JDBC": 5, "WriteNOS": 45}  # free worker slots per pool in a claim cycle


class Fixtures:
    """Derived inputs for one scale-factor directory.

    The feed and the load tables stay lazy views of the parquet files. The
    control tables (attributes, queue, history) are stored tables in a real
    deployment, so they are here: each is derived from the given tables once per
    application and folder, written to the shared work folder and scanned from
    there. ``store_control=False`` derives them anew inside each query.
    """

    _stored: dict[tuple[str, ...], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, store_control: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.store_control = store_control

    def _control(self, name: str, build) -> DataFrame:
        if not self.store_control:
            return build()
        zone = self.spark.conf.get("spark.sql.session.timeZone")  # must not matter, and is tested not to
        key = (self.spark.sparkContext.applicationId, zone, self.sf_dir, name)
        if key not in self._stored:
            self._stored[key] = materialize(build(), f"control_{name}")
        return self._stored[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- feed and attributes -------------------------------------------------
    @property
    def feed(self) -> DataFrame:
        ev = self.table("events")
        return ev.select(
            F.concat(F.lit("SRC.T"), ev.user_id.cast("string")).alias("source_table"),
            "user_id", "event_id", F.col("ts").alias("event_time"),
        )

    @property
    def attrs(self) -> DataFrame:
        return self._control("attrs", self._attrs)

    def _attrs(self) -> DataFrame:
        c = self.table("customer")
        k = c.c_custkey
        return c.select(
            F.concat(F.lit("SRC.T"), k.cast("string")).alias("source_table"),
            F.when(k % 3 == 0, F.lit(None).cast("string"))
            .when(k % 3 == 1, F.concat(F.lit("TGT.T"), k.cast("string")))
            .otherwise(F.concat(F.lit("LAKE.TGT.T"), k.cast("string"))).alias("target_table"),
            F.when(k % 2 == 0, F.lit("cdc")).otherwise(F.lit("snapshot")).alias("ingestion_strategy"),
            F.when(k % 2 == 0, F.lit("upd_ts")).alias("cdc_watermark"),
            F.when(k % 4 < 2, F.lit("id")).alias("primary_key"),
            F.when(c.c_mktsegment.isin("MACHINERY", "BUILDING"), F.lit("JDBC"))
            .when(c.c_mktsegment == "FURNITURE", F.lit("TPT"))
            .otherwise(F.lit("WriteNOS")).alias("strategy"),
            (c.c_nationkey % 7 == 0).alias("disabled"),
            (F.lit(1) + c.c_nationkey % 5).alias("priority"),
            ((k % 4) * 30).cast("int").alias("min_staleness"),
            (60 * (1 + k % 24)).cast("int").alias("max_staleness"),
        )

    @property
    def attrs_raw(self) -> DataFrame:
        """Attributes as text rows, some of them malformed (for validation)."""
        c = self.table("customer")
        k = c.c_custkey
        ks = k.cast("string")
        return c.select(
            F.when(k % 97 == 5, F.concat(F.lit("T"), ks))
            .when(k % 97 == 6, F.concat(F.lit("A.B.C.T"), ks))
            .otherwise(F.concat(F.lit("SRC.T"), ks)).alias("source_table"),
            F.when(k % 3 == 0, F.lit(""))
            .when(k % 3 == 1, F.concat(F.lit("TGT.T"), ks))
            .otherwise(F.concat(F.lit("LAKE.TGT.T"), ks)).alias("target_table"),
            F.when(k % 2 == 0, F.lit("cdc")).otherwise(F.lit("snapshot")).alias("ingestion_strategy"),
            F.when(k % 2 == 0, F.lit("upd_ts")).alias("cdc_watermark"),
            F.when(k % 4 < 2, F.lit("id")).alias("primary_key"),
            F.when(k % 89 == 3, F.lit("BadMethod"))
            .when(c.c_mktsegment.isin("MACHINERY", "BUILDING"), F.lit("JDBC"))
            .when(c.c_mktsegment == "FURNITURE", F.lit("TPT"))
            .otherwise(F.lit("WriteNOS")).alias("strategy"),
            F.when(k % 83 == 2, F.lit("notabool"))
            .when(c.c_nationkey % 7 == 0, F.lit(" TRUE"))
            .otherwise(F.lit("false")).alias("disabled"),
            (F.lit(1) + c.c_nationkey % 5).alias("priority"),
            F.when(k % 4 == 0, F.lit(None).cast("int"))
            .otherwise(((k % 4) * 30).cast("int")).alias("min_staleness"),
            F.when(k % 101 == 7, F.lit(None).cast("int"))
            .otherwise((60 * (1 + k % 24)).cast("int")).alias("max_staleness"),
        )

    @property
    def incoming(self) -> DataFrame:
        f = self.feed
        return f.where((f.event_time > ntz(CYCLE_START)) & (f.event_time <= ntz(CYCLE_END)))

    # -- queue and history before a cycle ------------------------------------
    @property
    def queue(self) -> DataFrame:
        return self._control("queue", self._queue)

    def _queue(self) -> DataFrame:
        f = self.feed
        grouped = (
            f.where((f.event_time > ntz(QUEUE_FROM)) & (f.event_time <= ntz(CYCLE_START)))
            .groupBy("source_table", "user_id")
            .agg(F.min("event_time").alias("event_time"), F.max("event_time").alias("last_time"),
                 F.count(F.lit(1)).alias("n"))
        )
        a = self.attrs.where(~F.col("disabled"))
        j = grouped.join(a.select("source_table", F.col("target_table").alias("a_target"), "primary_key",
                                  "strategy", "priority"), "source_table")
        running = j.user_id % 5 == 0
        return j.select(
            "source_table",
            F.coalesce("a_target", "source_table").alias("target_table"),
            F.lit("").alias("where_clause"),
            "primary_key",
            "event_time",
            F.when(running, ntz(CYCLE_START)).alias("trigger_time"),
            "strategy",
            F.lit(True).alias("lock_rows"),
            F.when(running, F.lit("R")).otherwise(F.lit("Q")).alias("status"),
            "priority",
            F.when(j.n > 1, j.last_time).alias("event_time_latest"),
        )

    @property
    def history(self) -> DataFrame:
        return self._control("history", self._history)

    def _history(self) -> DataFrame:
        f = self.feed
        old = f.where(f.event_time <= ntz(QUEUE_FROM)).select(
            "source_table",
            F.lit(None).cast("string").alias("target_table"),
            F.lit(None).cast("string").alias("where_clause"),
            F.lit(None).cast("string").alias("primary_key"),
            F.when(f.event_id % 3 == 0, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
            "event_time",
            F.lit(None).cast("timestamp_ntz").alias("trigger_time"),
            F.lit(None).cast("string").alias("strategy"),
            F.lit(None).cast("boolean").alias("lock_rows"),
            F.lit(None).cast("int").alias("priority"),
            F.col("event_id").alias("num_records"),
        )
        q = self.queue
        cols = ["source_table", "target_table", "where_clause", "primary_key"]
        tail = ["event_time", "trigger_time", "strategy", "lock_rows", "priority"]
        # Running rows, and queued direct rows already loaded once, from one pass over the queue.
        running = q.status == "R"
        known = q.where(running | ((q.status == "Q") & (q.strategy == "JDBC"))).select(
            *cols, F.when(running, F.lit("RUNNING")).otherwise(F.lit("SUCCESS")).alias("status"), *tail,
            F.when(running, F.lit(None)).otherwise(F.lit(1)).cast("bigint").alias("num_records"))
        allrows = old.unionByName(known)
        return allrows.select(
            "source_table", "target_table", "where_clause", "primary_key", "status", "event_time",
            "trigger_time", F.lit(None).cast("timestamp_ntz").alias("finish_time"),
            F.lit(None).cast("double").alias("duration_min"), "strategy", "lock_rows", "priority",
            F.lit(None).cast("string").alias("error"), "num_records",
        )

    # -- load source and target ----------------------------------------------
    @property
    def load_source(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            "o_orderkey", "o_custkey", "o_orderstatus",
            F.when(o.o_orderkey % 7 == 0, o.o_totalprice + 100).otherwise(o.o_totalprice).alias("o_totalprice"),
            "o_orderdate", "o_orderpriority",
        )

    @property
    def load_target(self) -> DataFrame:
        o = self.table("orders")
        return o.where(o.o_orderdate < ntz(TARGET_CUTOFF))

    # -- completions of the running loads --------------------------------------
    @property
    def completions(self) -> DataFrame:
        """Finish records for every running queue row (even priority -> FAILED)."""
        q = self.queue
        q = q.where(q.status == "R")
        failed = q.priority % 2 == 0
        finish = ntz(COMPLETE_AS_OF)
        return q.select(
            "source_table", "event_time",
            F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
            finish.alias("finish_time"),
            F.round(seconds_between(q.trigger_time, finish) / 60.0, 2).alias("duration_min"),
            (q.priority * 100).cast("bigint").alias("num_records"),
            F.when(failed, F.lit(FAILED_ERROR)).otherwise(F.lit("")).alias("error"),
        )
