"""Report, event-time and ad-hoc SQL queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import timeexpr as tx
from tidemark.operators import queue as qops
from tidemark.operators.reconcile import load_report
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import register
from tidemark.sources.sql import adhoc_sql

ZONE = "America/Phoenix"  # no daylight saving: local = UTC - 7 h all year

_FINISHED = """
SELECT h.source_table, h.strategy, c.status, h.trigger_time, c.finish_time, c.num_records, c.error
FROM history h JOIN completions c ON c.source_table = h.source_table AND c.event_time = h.event_time"""


def _report_time_sql(x: str) -> str:
    return f"strftime({x} - INTERVAL 7 HOUR, '%-m/%-d/%y %-I:%M %p')"


@register("load_report", O.with_views(f"""
SELECT source_table AS "table", lower(strategy) AS strategy, status, trigger_time AS start, finish_time AS "end",
  dur AS duration_min, num_records, trim(coalesce(replace(error, chr(39), ''), '')) AS error,
  concat_ws(',', source_table, lower(strategy), status, {_report_time_sql('trigger_time')},
            {_report_time_sql('finish_time')}, printf('%.2f', dur), CAST(num_records AS VARCHAR),
            trim(coalesce(replace(error, chr(39), ''), ''))) AS line
FROM (SELECT *, round(date_diff('second', trigger_time, finish_time) / 60.0, 2) AS dur FROM finished) f""",
                                      "history", "completions", extra={"finished": _FINISHED}))
def q_load_report(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return load_report(qops.history_after_complete(fx.history, fx.completions), ZONE)


@register("event_time_format", O.with_views("""
SELECT event_id, ts AS event_time, strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS local_text,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc_text,
  date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS epoch,
  TIMESTAMP '1970-01-01 00:00:00' + to_seconds(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts)) AS from_epoch
FROM events"""))
def q_event_time_format(spark, sf_dir):
    ev = Fixtures(spark, sf_dir).table("events")
    epoch = tx.epoch_seconds(ev.ts)
    return ev.select("event_id", ev.ts.alias("event_time"), tx.local_text(ev.ts, ZONE).alias("local_text"),
                     tx.format_text(ev.ts).alias("utc_text"), epoch.alias("epoch"),
                     tx.from_epoch(epoch).alias("from_epoch"))


_TEXTS = """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN replace(t, ' ', 'T') || 'Z'
                      WHEN event_id % 10 = 1 THEN '2024-13-' || substr(t, 9) ELSE t END AS text
FROM (SELECT event_id, strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS t FROM events) e"""


@register("event_time_parse", O.with_views(r"""
SELECT event_id, text, ok AS valid, CASE WHEN ok THEN try_strptime(text, '%Y-%m-%d %H:%M:%S') + INTERVAL 7 HOUR END
  AS event_time,
  CASE WHEN ok THEN date_diff('second', TIMESTAMP '1970-01-01 00:00:00',
                              try_strptime(text, '%Y-%m-%d %H:%M:%S') + INTERVAL 7 HOUR) END AS epoch
FROM (SELECT *, coalesce(regexp_full_match(text, '\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}')
                         AND try_strptime(text, '%Y-%m-%d %H:%M:%S') IS NOT NULL, false) AS ok FROM texts) x""",
                                           extra={"texts": _TEXTS}))
def q_event_time_parse(spark, sf_dir):
    ev = Fixtures(spark, sf_dir).table("events")
    local = tx.local_text(ev.ts, ZONE)
    text = (F.when(ev.event_id % 10 == 0, F.concat(F.regexp_replace(local, " ", "T"), F.lit("Z")))
             .when(ev.event_id % 10 == 1, F.concat(F.lit("2024-13-"), F.substring(local, 9, 100)))
             .otherwise(local))
    t = ev.select("event_id", text.alias("text"))
    parsed = tx.parse_local_text(F.col("text"), ZONE)
    return t.select("event_id", "text", tx.is_valid_text(F.col("text")).alias("valid"),
                    parsed.alias("event_time"), tx.epoch_seconds(parsed).alias("epoch"))


_ADHOC = """
SELECT q.source_table, q.status, q.strategy, a.ingestion_strategy, a.max_staleness
FROM {queue} q JOIN {attrs} a ON q.source_table = a.source_table
WHERE q.status = 'R'"""


@register("adhoc_sql", O.with_views(_ADHOC.format(queue="queue", attrs="attrs"), "queue", "attrs"))
def q_adhoc_sql(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return adhoc_sql(spark, _ADHOC.format(queue="tm_queue", attrs="tm_attrs"),
                     {"tm_queue": fx.queue, "tm_attrs": fx.attrs})
