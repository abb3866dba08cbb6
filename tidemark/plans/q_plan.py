"""Enqueue as one poll does it: checked attributes, a plan per table, and what changes rank with time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import feed as feedops
from tidemark.operators import ranking
from tidemark.plans import cycle
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import CATALOG, CYCLE_END, CYCLE_START, RANK_AS_OF, Fixtures
from tidemark.plans.q_feed import _validate_sql
from tidemark.plans.registry import register
from tidemark.session import work_path
from tidemark.sinks import tables

# The planned tables, each with its change column and the rows its target already has.
PLANNED = {
    "orders": ("o_orderdate", "o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'"),
    "lineitem": ("l_shipdate", "l_shipdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'"),
    "events": ("ts", "ts < TIMESTAMP_NTZ'2024-01-20 12:00:00'"),
    "customer": ("c_custkey", "c_custkey % 2 = 0"),
    "supplier": ("s_suppkey", "s_suppkey < 0"),  # a target without rows
    "part": ("no_such_column", "true"),  # a table that cannot be planned
    "nation": (None, "true"),  # no change column: a full load
}
PLAN_CUTOFF = 100
_NAMES = list(PLANNED)


def _planned_name(user_id):
    """The feed's users stand for the planned tables in turn."""
    return F.concat(F.lit("SRC."), F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (user_id % len(_NAMES) + 1).cast("int")))


def _planned_attrs(spark) -> DataFrame:
    rows = [(f"SRC.{n}", f"LAKE.TGT.{n}", "cdc" if c else "snapshot", c, None, "WriteNOS" if i % 2 else "TPT", False, 1 + i, 0, 60)
            for i, (n, (c, _)) in enumerate(PLANNED.items())]
    rows += [("SRC.region", "LAKE.TGT.region", "snapshot", None, None, "JDBC", False, 1, 0, 60)] * 2  # not in the feed
    from tidemark.schemas import ATTRS
    return spark.createDataFrame(rows, ATTRS)


def _mark_sql(name: str, column: str, where: str) -> str:
    where = where.replace("TIMESTAMP_NTZ", "TIMESTAMP ")
    mark = f"(SELECT max({column}) FROM {name} WHERE {where})"
    return (f"SELECT 'SRC.{name}' AS source_table, '{column}' AS cdc_column, CAST({mark} AS VARCHAR) AS hwm, "
            f"(SELECT count(*) FROM {name} WHERE {column} >= {mark}) AS pending")


_PLAN_SQL = f"""
SELECT c.source_table, 'LAKE.TGT.' || substr(c.source_table, 5) AS target_table,
  CASE WHEN m.hwm IS NULL THEN '' ELSE m.cdc_column || ' >= ''' || m.hwm || '''' END AS where_clause, '' AS primary_key,
  c.first_time AS event_time, CAST(NULL AS TIMESTAMP) AS trigger_time,
  CASE WHEN m.hwm IS NULL THEN CASE WHEN k.i % 2 = 1 THEN 'WriteNOS' ELSE 'TPT' END
       WHEN m.pending < {PLAN_CUTOFF} THEN 'JDBC' ELSE 'WriteNOS' END AS strategy,
  true AS lock_rows, 'Q' AS status, CAST(1 + k.i AS INTEGER) AS priority,
  CASE WHEN c.n > 1 THEN c.last_time END AS event_time_latest
FROM (SELECT 'SRC.' || list_extract({_NAMES!r}, user_id % {len(_NAMES)} + 1) AS source_table, min(event_time) AS first_time,
             max(event_time) AS last_time, count(*) AS n FROM incoming GROUP BY 1) c
JOIN (SELECT 'SRC.' || list_extract({_NAMES!r}, j + 1) AS source_table, j AS i FROM range({len(_NAMES)}) r(j)) k USING (source_table)
LEFT JOIN marks m USING (source_table)"""


@register("enqueue_with_plan", O.with_views(_PLAN_SQL, "incoming", extra={"marks": " UNION ALL ".join(
    _mark_sql(n, c, w) for n, (c, w) in PLANNED.items() if c and c != "no_such_column")}))
def q_enqueue_with_plan(spark, sf_dir):
    """A poll over unlike tables: marks of several types, a target without rows, a table that cannot be planned and one
    without a change column; each gets its own strategy and predicate in the queue."""
    fx = Fixtures(spark, sf_dir)
    root = work_path(spark, "planned")
    for name, (_, where) in PLANNED.items():
        tables.publish(fx.table(name).where(where), f"{root}/{name}")
    feed = fx.feed.select(_planned_name(F.col("user_id")).alias("source_table"), "event_time")
    empty = fx.queue.limit(0)
    return cycle.enqueue(empty, feed, _planned_attrs(spark), CATALOG, CYCLE_START, CYCLE_END, cutoff=PLAN_CUTOFF,
                         locate=lambda source, target: (f"{fx.sf_dir}/{source[4:]}.parquet", f"{root}/{source[4:]}"))


_TWICE = "SELECT * FROM attrs_raw UNION ALL SELECT * FROM attrs_raw WHERE priority = 5"


@register("enqueue_rejects", O.with_views("""
SELECT DISTINCT source_table, reject_reason FROM checked
WHERE NOT valid AND source_table IN (SELECT source_table FROM incoming)""", "attrs_raw", "incoming", extra={
    "open_rows": f"SELECT * FROM ({_TWICE}) t WHERE lower(trim(disabled)) <> 'true'",
    "checked": _validate_sql("open_rows", False)}))
def q_enqueue_rejects(spark, sf_dir):
    """Tables of the feed left out of the queue: attributes that are no good, or there twice."""
    fx = Fixtures(spark, sf_dir)
    raw = fx.attrs_raw
    return feedops.enqueue_rejects(fx.incoming, raw.unionByName(raw.where("priority = 5")))


# Fixed value: the later of the two instants.
LATER = "2024-01-19 03:20:30"


def _weights_sql(as_of: str) -> str:
    tier = O.tier_sql(O.staleness_sql(as_of))
    return f"""SELECT q.source_table, q.event_time, CAST(q.priority * {tier} AS INTEGER) AS priority
FROM queue q JOIN attrs d USING (source_table) WHERE q.status = 'Q'"""


@register("priority_changes", O.with_views("""
SELECT source_table, event_time, nullif(greatest(b.priority, 0), 0) AS before, nullif(greatest(a.priority, 0), 0) AS after
FROM earlier b JOIN later a USING (source_table, event_time)
WHERE nullif(greatest(b.priority, 0), 0) IS DISTINCT FROM nullif(greatest(a.priority, 0), 0)""", "queue", "attrs", extra={
    "earlier": _weights_sql(RANK_AS_OF), "later": _weights_sql(LATER)}))
def q_priority_changes(spark, sf_dir):
    """Queued rows whose weight changes between two instants, found by the minute their step ends."""
    fx = Fixtures(spark, sf_dir)
    return ranking.changed_priorities(fx.queue, fx.attrs, RANK_AS_OF, LATER)
