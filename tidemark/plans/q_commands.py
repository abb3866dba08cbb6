"""Queries over the command stream: feed, claims and completions through one writer, with restarts between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeexpr import ntz, seconds_between
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import CATALOG, CYCLE_END, CYCLE_START, FAILED_ERROR, SLOTS, Fixtures
from tidemark.plans.registry import register
from tidemark.schemas import RUNNING_FLAG
from tidemark.session import work_path
from tidemark.streaming import commands

# Fixed values of the cycle: the second half of the feed arrives after the claims.
NOON = "2024-01-20 12:00:00"
DONE_AT = "2024-01-21 00:45:30"


def _halves(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    rows = fx.incoming.select("source_table", "event_time")
    return rows.where(F.col("event_time") <= ntz(NOON)), rows.where(F.col("event_time") > ntz(NOON))


def _finished(queue: DataFrame) -> DataFrame:
    """Finish records of the rows that run since the cycle's end (even priority: failed)."""
    failed = F.col("priority") % 2 == 0
    return queue.where((F.col("status") == RUNNING_FLAG) & (F.col("trigger_time") == ntz(CYCLE_END))).select(
        "source_table", "event_time", F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        ntz(DONE_AT).alias("finish_time"),
        F.round(seconds_between(F.col("trigger_time"), ntz(DONE_AT)) / 60.0, 2).alias("duration_min"),
        (F.col("priority") * 100).cast("bigint").alias("num_records"),
        F.when(failed, F.lit(FAILED_ERROR)).otherwise("").alias("error"))


_SIDES = """
SELECT 'queue' AS side, source_table, event_time, trigger_time, strategy, status, priority, event_time_latest,
  CAST(NULL AS TIMESTAMP) AS finish_time, CAST(NULL AS BIGINT) AS num_records, CAST(NULL AS VARCHAR) AS error FROM queue3
UNION ALL
SELECT 'history', source_table, event_time, trigger_time, strategy, status, priority, NULL, finish_time, num_records, error
FROM history3
UNION ALL
SELECT 'refused', source_table, event_time, NULL, NULL, 'claimed more than once', NULL, NULL, NULL, NULL, NULL FROM claims2
UNION ALL
SELECT 'refused', source_table, event_time, NULL, NULL, 'row does not run', NULL, NULL, NULL, NULL, NULL FROM done2"""


@register("stream_dispatch_cycle", O.with_views(_SIDES, "incoming", "queue", "history", "attrs", extra={
    "first_half": f"SELECT * FROM incoming WHERE event_time <= TIMESTAMP '{NOON}'",
    "second_half": f"SELECT * FROM incoming WHERE event_time > TIMESTAMP '{NOON}'",
    "records1": O.records_sql("first_half"), "queue1": O.upserted_sql("queue", "records1"),
    "weighted2": O.weighted_sql(CYCLE_END, source="queue1"), "ranked2": O.ranked_sql("weighted2"),
    "claims2": O._claims_sql(SLOTS["JDBC"], SLOTS["WriteNOS"], ranked="ranked2"),
    "claimed": O.claimed_queue_sql("queue1", "claims2", CYCLE_END),
    "history2": O.claimed_history_sql("history", "claims2", CYCLE_END),
    "records2": O.records_sql("second_half"), "queue2": O.upserted_sql("claimed", "records2"),
    "done2": f"SELECT * FROM queue2 WHERE status = 'R' AND trigger_time = TIMESTAMP '{CYCLE_END}'",
    "queue3": """SELECT * FROM queue2 q WHERE NOT EXISTS (
  SELECT 1 FROM done2 d WHERE d.source_table = q.source_table AND d.event_time = q.event_time)""",
    "history3": f"""
SELECT h.* REPLACE (
  CASE WHEN d.source_table IS NULL THEN h.status WHEN d.priority % 2 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN d.source_table IS NULL THEN h.finish_time ELSE TIMESTAMP '{DONE_AT}' END AS finish_time,
  CASE WHEN d.source_table IS NULL THEN h.num_records ELSE CAST(d.priority * 100 AS BIGINT) END AS num_records,
  CASE WHEN d.source_table IS NULL THEN h.error WHEN d.priority % 2 = 0 THEN 'load failed: cant reach source' ELSE '' END AS error)
FROM history2 h LEFT JOIN done2 d ON d.source_table = h.source_table AND d.event_time = h.event_time"""}))
def q_stream_dispatch_cycle(spark, sf_dir):
    """Half a day's feed, claims by two dispatchers from one version, the other half, completions delivered twice;
    the stream is started anew for each step. Queue, history and refused commands at the end."""
    fx = Fixtures(spark, sf_dir, store_control=True)
    folders = commands.Folders(work_path(spark, "stream_dispatch"))

    def run() -> commands.State:
        commands.start_commands(spark, folders, lambda: fx.attrs, CATALOG, initial=(fx.queue, fx.history)).awaitTermination()
        return commands.read_state(spark, folders)

    early, late = _halves(fx)
    folders.create(spark)
    early.write.mode("append").parquet(folders.feed)
    run()
    for _ in range(2):  # two dispatchers see the same version
        commands.issue_claims(spark, folders, fx.attrs, CYCLE_END, SLOTS)
    late.write.mode("append").parquet(folders.feed)
    done = _finished(run().queue)
    commands.issue_completions(spark, folders, done, DONE_AT)
    run()
    commands.issue_completions(spark, folders, done, DONE_AT)  # delivered again
    state = run()
    sides = ["source_table", "event_time", "trigger_time", "strategy", "status", "priority"]
    refused = spark.read.parquet(folders.refused).select(F.lit("refused").alias("side"), *[
        F.col("reason").alias("status") if c == "status" else F.col(c) for c in ("source_table", "event_time", "status")])
    return (state.queue.select(F.lit("queue").alias("side"), *sides, "event_time_latest")
            .unionByName(state.history.select(F.lit("history").alias("side"), *sides, "finish_time", "num_records", "error"),
                         allowMissingColumns=True)
            .unionByName(refused, allowMissingColumns=True))


DELAY = "2 hours"


@register("stream_replayed_feed", O.with_views(f"""
SELECT source_table, event_time, status, priority, event_time_latest, CAST(NULL AS BIGINT) AS late_rows FROM upserted
UNION ALL
SELECT source_table, max(event_time), 'late', NULL, NULL, count(*) FROM incoming
WHERE event_time <= (SELECT max(event_time) FROM incoming WHERE event_time <= TIMESTAMP '{NOON}') - INTERVAL 2 HOUR
GROUP BY source_table""", "upserted", "incoming"))
def q_stream_replayed_feed(spark, sf_dir):
    """The feed in two halves, the first half again before the second, then all of it under a new checkpoint: one queue.
    Rows delivered again are dropped as duplicates while they are remembered, and kept aside as late after that."""
    fx = Fixtures(spark, sf_dir, store_control=True)
    folders = commands.Folders(work_path(spark, "stream_replay"))

    def run(checkpoint: str) -> None:
        commands.start_commands(spark, folders, lambda: fx.attrs, CATALOG, initial=(fx.queue, fx.history),
                                checkpoint=f"{folders.root}/{checkpoint}", delay=DELAY).awaitTermination()

    early, late = _halves(fx)
    folders.create(spark)
    for part in (early, early, late):
        part.write.mode("append").parquet(folders.feed)
        run("first")
    run("second")
    aside = commands.read_late(spark, folders).groupBy("source_table").agg(
        F.max("event_time").alias("event_time"), F.lit("late").alias("status"), F.count("*").alias("late_rows"))
    return (commands.read_state(spark, folders).queue.select("source_table", "event_time", "status", "priority", "event_time_latest")
            .unionByName(aside, allowMissingColumns=True))
