"""Feed queries: scan, coalesce, attribute lookup, enrichment, validation, records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import feed as feedops
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import CATALOG, CYCLE_END, CYCLE_START, Fixtures
from tidemark.plans.registry import register
from tidemark.sources.feed import incremental_scan


def records(fx: Fixtures) -> DataFrame:
    return feedops.enqueue_from_feed(fx.incoming, fx.attrs, CATALOG)


@register("feed_incremental_scan", O.with_views(f"""
SELECT source_table, event_time, event_id FROM feed
WHERE event_time > TIMESTAMP '{CYCLE_START}' AND event_time <= TIMESTAMP '{CYCLE_END}'""", "feed"))
def q_feed_incremental_scan(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return incremental_scan(fx.feed, CYCLE_START, CYCLE_END, keep=("event_id",))


@register("feed_coalesce", O.with_views("""
SELECT source_table, min(event_time) AS first_event_time, max(event_time) AS latest_event_time, count(*) AS events
FROM incoming GROUP BY source_table""", "incoming"))
def q_feed_coalesce(spark, sf_dir):
    return feedops.coalesce_feed(Fixtures(spark, sf_dir).incoming)


@register("feed_table_attrs", O.with_views("""
SELECT * FROM attrs WHERE source_table IN (SELECT source_table FROM incoming) AND disabled = false""",
                                           "attrs", "incoming"))
def q_feed_table_attrs(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return feedops.table_attrs(fx.attrs, fx.incoming)


@register("feed_enrich", O.with_views("""
SELECT i.source_table, i.user_id, i.event_id, i.event_time, a.target_table, a.ingestion_strategy, a.cdc_watermark,
  a.primary_key, a.strategy, a.priority, a.min_staleness, a.max_staleness
FROM incoming i, attrs a WHERE i.source_table = a.source_table AND NOT a.disabled""", "incoming", "attrs"))
def q_feed_enrich(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return feedops.enrich(fx.incoming, fx.attrs)


def _parts(x: str) -> str:
    return f"(CASE WHEN coalesce({x}, '') = '' THEN 0 ELSE len(string_split({x}, '.')) END)"


def _validate_sql(view: str, arity: bool) -> str:
    """Attribute validation written directly in SQL over ``view`` (text or typed fields)."""
    arity_reason = "CASE WHEN nfields <> 10 THEN 'line must have 10 fields' END," if arity else ""
    return f"""
SELECT source_table, tgt AS target_table, ingestion_strategy, cdc_watermark, primary_key, strategy,
  CASE lower(trim(disabled)) WHEN 'true' THEN true WHEN 'false' THEN false END AS disabled,
  prio AS priority, coalesce(min_i, 0) AS min_staleness, max_i AS max_staleness,
  reasons = '' AS valid, nullif(reasons, '') AS reject_reason
FROM (
  SELECT *, concat_ws('; ', {arity_reason}
    CASE WHEN {_parts('source_table')} NOT IN (2, 3) THEN 'source_table must have 2 or 3 name parts' END,
    CASE WHEN {_parts('tgt')} NOT IN (2, 3) THEN 'target_table must have 2 or 3 name parts' END,
    CASE WHEN strategy IS NULL OR strategy NOT IN ('TPT', 'WriteNOS', 'JDBC')
         THEN 'strategy must be TPT, WriteNOS or JDBC' END,
    CASE WHEN lower(trim(disabled)) IS NULL OR lower(trim(disabled)) NOT IN ('true', 'false')
         THEN 'disabled must be true or false' END,
    CASE WHEN prio IS NULL THEN 'priority is required' END,
    CASE WHEN max_i IS NULL THEN 'max_staleness is required' END,
    CASE WHEN min_staleness IS NOT NULL AND min_i IS NULL THEN 'min_staleness must be a number' END,
    CASE WHEN copies > 1 THEN 'duplicate source_table' END) AS reasons
  FROM (SELECT *, coalesce(nullif(target_table, ''), source_table) AS tgt,
               TRY_CAST(priority AS INTEGER) AS prio, TRY_CAST(min_staleness AS INTEGER) AS min_i,
               TRY_CAST(max_staleness AS INTEGER) AS max_i,
               count(*) OVER (PARTITION BY source_table) AS copies FROM {view}) r0
) r1"""


_LINE_FIELDS = ["source_table", "target_table", "ingestion_strategy", "cdc_watermark", "primary_key",
                "strategy", "disabled", "priority", "min_staleness", "max_staleness"]


def _line_sql(fields) -> str:
    return "concat_ws(',', " + ", ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in fields) + ")"


_ATTR_LINES = f"""
SELECT CASE WHEN right(source_table, 1) = '7' THEN {_line_sql(_LINE_FIELDS[:7])}
            ELSE {_line_sql(_LINE_FIELDS)} END AS value
FROM attrs_raw"""

_PARSED = """
SELECT """ + ", ".join(f"nullif(trim(p[{i + 1}]), '') AS {f}" for i, f in enumerate(_LINE_FIELDS)) + """,
  len(p) AS nfields
FROM (SELECT string_split(value, ',') AS p FROM attr_lines) l"""


@register("attrs_lines_validate", O.with_views(_validate_sql("parsed", True), "attrs_raw",
                                               extra={"attr_lines": _ATTR_LINES, "parsed": _PARSED}))
def q_attrs_lines_validate(spark, sf_dir):
    """Attributes arriving as delimited text lines (some cut short) -> typed rows and rejects."""
    raw = Fixtures(spark, sf_dir).attrs_raw

    def line(fields):
        return F.concat_ws(",", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])

    lines = raw.select(F.when(F.substring("source_table", -1, 1) == "7", line(_LINE_FIELDS[:7]))
                       .otherwise(line(_LINE_FIELDS)).alias("value"))
    return feedops.validate_attrs(feedops.attrs_from_lines(lines))


@register("attrs_validate", O.with_views(_validate_sql("attrs_raw", False), "attrs_raw"))
def q_attrs_validate(spark, sf_dir):
    return feedops.validate_attrs(Fixtures(spark, sf_dir).attrs_raw)


@register("enqueue_records", O.with_views("SELECT * FROM records", "records"))
def q_enqueue_records(spark, sf_dir):
    return records(Fixtures(spark, sf_dir))


@register("enqueue_all_tables", O.with_views("""
SELECT source_table, 'main.' || source_table AS target_table, '' AS where_clause, CAST(NULL AS VARCHAR) AS primary_key,
  event_time, CAST(NULL AS TIMESTAMP) AS trigger_time, 'WriteNOS' AS strategy, true AS lock_rows, 'Q' AS status,
  1 AS priority, nullif(last_time, event_time) AS event_time_latest
FROM (SELECT DISTINCT source_table, first_value(event_time) OVER t AS event_time, last_value(event_time) OVER t AS last_time
      FROM incoming WINDOW t AS (PARTITION BY source_table ORDER BY event_time
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) x""", "incoming"))
def q_enqueue_all_tables(spark, sf_dir):
    return feedops.enqueue_all_tables(Fixtures(spark, sf_dir).incoming.select("source_table", "event_time"), CATALOG)
