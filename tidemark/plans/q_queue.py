"""Queue and history transition queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import feed as feedops
from tidemark.operators import queue as qops
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import CATALOG, CYCLE_END, CYCLE_START, RANK_AS_OF, SLOTS, Fixtures
from tidemark.plans.q_feed import records
from tidemark.plans.q_ranking import claims
from tidemark.plans.registry import register


@register("queue_upsert", O.with_views("SELECT * FROM upserted", "upserted"))
def q_queue_upsert(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.queue_upsert(fx.queue, records(fx))


def batch_frame(fx: Fixtures) -> DataFrame:
    """A batch-enqueue frame with only source_table, strategy and (sometimes) event_time."""
    c = feedops.coalesce_feed(fx.incoming)
    a = feedops.enabled(fx.attrs).select("source_table", "strategy")
    return c.join(a, "source_table").select(
        "source_table", "strategy",
        F.when(F.col("events") > 2, F.col("latest_event_time")).alias("event_time"))


_BATCH = f"""
SELECT c.source_table, 'main.' || c.source_table AS target_table, '' AS where_clause, '' AS primary_key,
  coalesce(CASE WHEN c.n > 2 THEN c.last_time END, TIMESTAMP '{CYCLE_END}') AS event_time, a.strategy,
  true AS lock_rows, 'Q' AS status, 1 AS priority
FROM (SELECT source_table, max(event_time) AS last_time, count(*) AS n FROM incoming GROUP BY 1) c
JOIN attrs a ON a.source_table = c.source_table WHERE NOT a.disabled"""


@register("queue_batch_upsert", O.with_views("""
SELECT q.source_table,
  CASE WHEN s.source_table IS NULL THEN q.target_table ELSE s.target_table END AS target_table,
  CASE WHEN s.source_table IS NULL THEN q.where_clause ELSE s.where_clause END AS where_clause,
  CASE WHEN s.source_table IS NULL THEN q.primary_key ELSE s.primary_key END AS primary_key,
  CASE WHEN s.source_table IS NULL THEN q.event_time ELSE s.event_time END AS event_time,
  q.trigger_time,
  CASE WHEN s.source_table IS NULL THEN q.strategy ELSE s.strategy END AS strategy,
  CASE WHEN s.source_table IS NULL THEN q.lock_rows ELSE s.lock_rows END AS lock_rows,
  CASE WHEN s.source_table IS NULL THEN q.status ELSE s.status END AS status,
  CASE WHEN s.source_table IS NULL THEN q.priority ELSE s.priority END AS priority,
  q.event_time_latest
FROM queue q LEFT JOIN batch s ON q.source_table = s.source_table
UNION ALL
SELECT s.source_table, s.target_table, s.where_clause, s.primary_key, s.event_time, CAST(NULL AS TIMESTAMP),
  s.strategy, s.lock_rows, s.status, s.priority, CAST(NULL AS TIMESTAMP)
FROM batch s WHERE s.source_table NOT IN (SELECT source_table FROM queue)""",
                                             "incoming", "attrs", "queue", extra={"batch": _BATCH}))
def q_queue_batch_upsert(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.queue_batch_upsert(fx.queue, batch_frame(fx), CATALOG, CYCLE_END)


@register("queue_after_claim", O.with_views(f"""
SELECT q.source_table, q.target_table, q.where_clause, q.primary_key, q.event_time,
  CASE WHEN c.source_table IS NOT NULL THEN TIMESTAMP '{RANK_AS_OF}' ELSE q.trigger_time END AS trigger_time,
  q.strategy, q.lock_rows, CASE WHEN c.source_table IS NOT NULL THEN 'R' ELSE q.status END AS status,
  q.priority, q.event_time_latest
FROM queue q LEFT JOIN claims c ON q.source_table = c.source_table AND q.event_time = c.event_time""", "claims"))
def q_queue_after_claim(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.queue_after_claim(fx.queue, claims(fx, materialize=True), RANK_AS_OF)


@register("history_after_claim", O.with_views(f"""
SELECT * FROM history h
WHERE h.status = 'RUNNING'
   OR NOT EXISTS (SELECT 1 FROM claims c WHERE c.source_table = h.source_table AND c.event_time = h.event_time)
UNION ALL
SELECT c.source_table, c.target_table, c.where_clause, c.primary_key, 'RUNNING', c.event_time,
  TIMESTAMP '{RANK_AS_OF}', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), c.strategy, c.lock_rows, c.priority,
  CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
FROM claims c
WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.source_table = c.source_table AND h.event_time = c.event_time
                    AND h.status = 'RUNNING')""", "history", "claims"))
def q_history_after_claim(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.history_after_claim(fx.history, claims(fx, materialize=True), RANK_AS_OF)


@register("queue_after_complete", O.with_views("""
SELECT * FROM queue q
WHERE NOT (q.status = 'R' AND EXISTS (SELECT 1 FROM completions c
                                      WHERE c.source_table = q.source_table AND c.event_time = q.event_time))""",
                                               "queue", "completions"))
def q_queue_after_complete(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.queue_after_complete(fx.queue, fx.completions)


@register("history_after_complete", O.with_views("""
SELECT h.source_table, h.target_table, h.where_clause, h.primary_key,
  CASE WHEN c.source_table IS NULL THEN h.status ELSE c.status END AS status, h.event_time, h.trigger_time,
  CASE WHEN c.source_table IS NULL THEN h.finish_time ELSE c.finish_time END AS finish_time,
  CASE WHEN c.source_table IS NULL THEN h.duration_min ELSE c.duration_min END AS duration_min,
  h.strategy, h.lock_rows, h.priority,
  CASE WHEN c.source_table IS NULL THEN h.error ELSE replace(c.error, chr(39), '') END AS error,
  CASE WHEN c.source_table IS NULL THEN h.num_records ELSE c.num_records END AS num_records
FROM history h LEFT JOIN completions c ON c.source_table = h.source_table AND c.event_time = h.event_time""",
                                                 "history", "completions"))
def q_history_after_complete(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.history_after_complete(fx.history, fx.completions)


@register("requeue_running_queue", O.with_views("""
SELECT source_table, target_table, where_clause, primary_key, event_time, trigger_time, strategy, lock_rows,
  CASE status WHEN 'R' THEN 'Q' ELSE status END AS status, priority, event_time_latest FROM queue""", "queue"))
def q_requeue_running_queue(spark, sf_dir):
    return qops.requeue_running_queue(Fixtures(spark, sf_dir).queue)


@register("requeue_running_history", O.with_views("""
SELECT * FROM history h WHERE NOT EXISTS (
  SELECT 1 FROM queue q WHERE q.status = 'R' AND q.source_table = h.source_table AND q.event_time = h.event_time)""",
                                                  "history", "queue"))
def q_requeue_running_history(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.requeue_running_history(fx.history, fx.queue)


@register("queue_key_check", O.with_views("""
SELECT source_table, count(*) FILTER (WHERE status = 'Q') AS queued, count(*) FILTER (WHERE status = 'R') AS running
FROM (SELECT source_table, CASE status WHEN 'R' THEN 'Q' ELSE status END AS status FROM upserted) u
GROUP BY source_table
HAVING count(*) FILTER (WHERE status = 'Q') > 1 OR count(*) FILTER (WHERE status = 'R') > 1""", "upserted"))
def q_queue_key_check(spark, sf_dir):
    """Enqueue a cycle, then requeue running rows: tables that were running and got
    new events end with two queued rows (the gap in the reference's invariant)."""
    fx = Fixtures(spark, sf_dir)
    return qops.queue_key_check(qops.requeue_running_queue(qops.queue_upsert(fx.queue, records(fx))))


@register("queue_length", O.with_views("SELECT count(*) FILTER (WHERE status = 'Q') AS queued FROM queue", "queue"))
def q_queue_length(spark, sf_dir):
    return qops.queue_length(Fixtures(spark, sf_dir).queue)


@register("queued_records", O.with_views("SELECT * FROM queue WHERE status = 'Q'", "queue"))
def q_queued_records(spark, sf_dir):
    return qops.queued_records(Fixtures(spark, sf_dir).queue)


@register("queue_reset", O.with_views("SELECT * FROM queue WHERE false", "queue"))
def q_queue_reset(spark, sf_dir):
    return qops.queue_reset(Fixtures(spark, sf_dir).queue)


@register("resume_watermark", O.with_views("""
SELECT max(et) AS watermark FROM (
  SELECT max(coalesce(event_time_latest, event_time)) AS et FROM queue
  UNION ALL SELECT max(event_time) FROM history) m""", "queue", "history"))
def q_resume_watermark(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return qops.resume_watermark(fx.queue, fx.history, start=CYCLE_START)


# ---------------------------------------------------------------- one whole cycle
def _cycle(fx: Fixtures):
    from tidemark.plans import cycle
    q1 = cycle.enqueue(fx.queue, fx.feed, fx.attrs, CATALOG, CYCLE_START, CYCLE_END)
    return cycle.dispatch(q1, fx.history, fx.attrs, CYCLE_END, SLOTS)


_CYCLE_VIEWS = {"weighted2": O.weighted_sql(CYCLE_END, source="upserted"), "ranked2": O.ranked_sql("weighted2"),
                "claims2": O._claims_sql(SLOTS["JDBC"], SLOTS["WriteNOS"], ranked="ranked2")}


@register("cycle_queue", O.with_views(O.claimed_queue_sql("upserted", "claims2", CYCLE_END), "upserted", extra=_CYCLE_VIEWS))
def q_cycle_queue(spark, sf_dir):
    """Enqueue the cycle's feed, then rank and claim on the new queue: the queue after the cycle."""
    return _cycle(Fixtures(spark, sf_dir)).queue


@register("cycle_history", O.with_views(O.claimed_history_sql("history", "claims2", CYCLE_END), "upserted", "history",
                                       extra=_CYCLE_VIEWS))
def q_cycle_history(spark, sf_dir):
    """History after the same cycle's claims."""
    return _cycle(Fixtures(spark, sf_dir)).history


# ---------------------------------------------------------------- claim, load, complete
LOAD_SLOTS = {"JDBC": 2, "WriteNOS": 3}


def _orders_of(fx: Fixtures, source_table: str):
    """Source and target of a claimed table: the orders of its customer; every third one is not to be found."""
    n = int(source_table.removeprefix("SRC.T"))
    if n % 3 == 0:
        raise LookupError(f"no source for {source_table}")
    own = fx.table("orders").where(F.col("o_custkey") == n).select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice", "o_orderdate")
    return own, own.limit(0)


_OUTCOME = """
  CASE WHEN CAST(substr(c.source_table, 6) AS BIGINT) % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END"""


@register("cycle_load_complete", O.with_views(f"""
SELECT 'queue' AS side, q.source_table, q.event_time, q.status, CAST(NULL AS BIGINT) AS num_records, CAST(NULL AS VARCHAR) AS error
FROM queue q WHERE NOT EXISTS (SELECT 1 FROM claims5 c WHERE c.source_table = q.source_table AND c.event_time = q.event_time)
UNION ALL
SELECT 'history', h.source_table, h.event_time, CASE WHEN c.source_table IS NULL THEN h.status ELSE {_OUTCOME} END,
  CASE WHEN c.source_table IS NULL THEN h.num_records WHEN {_OUTCOME} = 'FAILED' THEN 0 ELSE (SELECT count(*) FROM orders o
    WHERE o.o_custkey = CAST(substr(c.source_table, 6) AS BIGINT)) END,
  CASE WHEN c.source_table IS NULL THEN h.error WHEN {_OUTCOME} = 'FAILED' THEN 'LookupError: no source for ' || c.source_table ELSE '' END
FROM claimed h LEFT JOIN claims5 c ON c.source_table = h.source_table AND c.event_time = h.event_time""",
                                              "queue", "history", "ranked", extra={
    "claims5": O._claims_sql(LOAD_SLOTS["JDBC"], LOAD_SLOTS["WriteNOS"]),
    "claimed": O.claimed_history_sql("history", "claims5", RANK_AS_OF)}))
def q_cycle_load_complete(spark, sf_dir):
    """Claim a few tables, load each, and complete them with what their loads report; some fail."""
    from tidemark.plans import cycle, flows
    fx = Fixtures(spark, sf_dir, store_control=True)
    step = cycle.dispatch(fx.queue, fx.history, fx.attrs, RANK_AS_OF, LOAD_SLOTS)
    done, _ = flows.load_claims(spark, step.claims, lambda source, target: _orders_of(fx, source))
    queue, history = cycle.complete(step.queue, step.history, done)
    sides = ["source_table", "event_time", "status"]
    return (queue.select(F.lit("queue").alias("side"), *sides)
            .unionByName(history.select(F.lit("history").alias("side"), *sides, "num_records", "error"), allowMissingColumns=True))
