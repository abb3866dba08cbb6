"""DuckDB SQL oracles, one per registered query.

Each oracle is written in a different form from the Spark code (full outer
joins where Spark uses anti joins and unions, correlated subqueries where
Spark uses windows, etc.). Base tables are the pre-registered views; the
derived control tables are CTEs.
"""

from __future__ import annotations

from tidemark.plans.fixtures import RANK_AS_OF, SLOTS

# Derived views (FIXTURES.md section 3), DuckDB dialect, in dependency order.
VIEWS: dict[str, str] = {
    "feed": """
SELECT 'SRC.T' || CAST(user_id AS VARCHAR) AS source_table, user_id, event_id, ts AS event_time FROM events""",
    "attrs": """
SELECT 'SRC.T' || CAST(c_custkey AS VARCHAR) AS source_table,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'TGT.T' || CAST(c_custkey AS VARCHAR)
       ELSE 'LAKE.TGT.T' || CAST(c_custkey AS VARCHAR) END AS target_table,
  CASE WHEN c_custkey % 2 = 0 THEN 'cdc' ELSE 'snapshot' END AS ingestion_strategy,
  CASE WHEN c_custkey % 2 = 0 THEN 'upd_ts' END AS cdc_watermark,
  CASE WHEN c_custkey % 4 < 2 THEN 'id' END AS primary_key,
  CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'JDBC' WHEN c_mktsegment = 'FURNITURE' THEN 'TPT'
       ELSE 'WriteNOS' END AS strategy,
  c_nationkey % 7 = 0 AS disabled, CAST(1 + c_nationkey % 5 AS INTEGER) AS priority,
  CAST((c_custkey % 4) * 30 AS INTEGER) AS min_staleness, CAST(60 * (1 + c_custkey % 24) AS INTEGER) AS max_staleness
FROM customer""",
    "attrs_raw": """
SELECT CASE WHEN c_custkey % 97 = 5 THEN 'T' || CAST(c_custkey AS VARCHAR)
            WHEN c_custkey % 97 = 6 THEN 'A.B.C.T' || CAST(c_custkey AS VARCHAR)
            ELSE 'SRC.T' || CAST(c_custkey AS VARCHAR) END AS source_table,
  CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN 'TGT.T' || CAST(c_custkey AS VARCHAR)
       ELSE 'LAKE.TGT.T' || CAST(c_custkey AS VARCHAR) END AS target_table,
  CASE WHEN c_custkey % 2 = 0 THEN 'cdc' ELSE 'snapshot' END AS ingestion_strategy,
  CASE WHEN c_custkey % 2 = 0 THEN 'upd_ts' END AS cdc_watermark,
  CASE WHEN c_custkey % 4 < 2 THEN 'id' END AS primary_key,
  CASE WHEN c_custkey % 89 = 3 THEN 'BadMethod' WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'JDBC'
       WHEN c_mktsegment = 'FURNITURE' THEN 'TPT' ELSE 'WriteNOS' END AS strategy,
  CASE WHEN c_custkey % 83 = 2 THEN 'notabool' WHEN c_nationkey % 7 = 0 THEN ' TRUE' ELSE 'false' END AS disabled,
  CAST(1 + c_nationkey % 5 AS INTEGER) AS priority,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST((c_custkey % 4) * 30 AS INTEGER) END AS min_staleness,
  CASE WHEN c_custkey % 101 = 7 THEN NULL ELSE CAST(60 * (1 + c_custkey % 24) AS INTEGER) END AS max_staleness
FROM customer""",
    "queue": """
SELECT f.source_table, coalesce(a.target_table, f.source_table) AS target_table, '' AS where_clause, a.primary_key,
  f.event_time, CASE WHEN f.user_id % 5 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' END AS trigger_time, a.strategy,
  true AS lock_rows, CASE WHEN f.user_id % 5 = 0 THEN 'R' ELSE 'Q' END AS status, a.priority,
  CASE WHEN f.n > 1 THEN f.last_time END AS event_time_latest
FROM (SELECT source_table, user_id, min(event_time) AS event_time, max(event_time) AS last_time, count(*) AS n
      FROM feed WHERE event_time > TIMESTAMP '2024-01-18 00:00:00' AND event_time <= TIMESTAMP '2024-01-20 00:00:00'
      GROUP BY source_table, user_id) f
JOIN attrs a ON f.source_table = a.source_table WHERE NOT a.disabled""",
    "history": """
SELECT source_table, CAST(NULL AS VARCHAR) AS target_table, CAST(NULL AS VARCHAR) AS where_clause,
  CAST(NULL AS VARCHAR) AS primary_key, CASE WHEN event_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  event_time, CAST(NULL AS TIMESTAMP) AS trigger_time, CAST(NULL AS TIMESTAMP) AS finish_time,
  CAST(NULL AS DOUBLE) AS duration_min, CAST(NULL AS VARCHAR) AS strategy, CAST(NULL AS BOOLEAN) AS lock_rows,
  CAST(NULL AS INTEGER) AS priority, CAST(NULL AS VARCHAR) AS error, event_id AS num_records
FROM feed WHERE event_time <= TIMESTAMP '2024-01-18 00:00:00'
UNION ALL
SELECT source_table, target_table, where_clause, primary_key, 'RUNNING', event_time, trigger_time,
  CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), strategy, lock_rows, priority, CAST(NULL AS VARCHAR),
  CAST(NULL AS BIGINT)
FROM queue WHERE status = 'R'
UNION ALL
SELECT source_table, target_table, where_clause, primary_key, 'SUCCESS', event_time, trigger_time,
  CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), strategy, lock_rows, priority, CAST(NULL AS VARCHAR),
  CAST(1 AS BIGINT)
FROM queue WHERE status = 'Q' AND strategy = 'JDBC'""",
    "incoming": """
SELECT * FROM feed WHERE event_time > TIMESTAMP '2024-01-20 00:00:00' AND event_time <= TIMESTAMP '2024-01-21 00:00:00'""",
    "load_source": """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders""",
    "load_target": """
SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'""",
}


def records_sql(feed: str = "incoming", attrs: str = "attrs") -> str:
    """One queue record for each table of a feed that has enabled attributes."""
    return f"""
SELECT c.source_table,
  CASE WHEN len(string_split(coalesce(nullif(a.target_table, ''), c.source_table), '.')) = 3
       THEN coalesce(nullif(a.target_table, ''), c.source_table)
       ELSE 'main.' || coalesce(nullif(a.target_table, ''), c.source_table) END AS target_table,
  '' AS where_clause, coalesce(a.primary_key, '') AS primary_key, c.first_time AS event_time,
  CAST(NULL AS TIMESTAMP) AS trigger_time, a.strategy, true AS lock_rows, 'Q' AS status, a.priority,
  CASE WHEN c.n > 1 THEN c.last_time END AS event_time_latest
FROM (SELECT source_table, min(event_time) AS first_time, max(event_time) AS last_time, count(*) AS n
      FROM {feed} GROUP BY source_table) c
JOIN {attrs} a ON a.source_table = c.source_table
WHERE a.disabled = false"""


def upserted_sql(queue: str = "queue", records: str = "records") -> str:
    """The queue after its records are merged into it."""
    return f"""
SELECT q.source_table, q.target_table, q.where_clause, q.primary_key, q.event_time, q.trigger_time, q.strategy,
  q.lock_rows, q.status,
  CASE WHEN r.source_table IS NOT NULL THEN r.priority ELSE q.priority END AS priority,
  CASE WHEN r.source_table IS NOT NULL
       THEN (SELECT max(x) FROM (VALUES (q.event_time_latest), (q.event_time), (r.event_time_latest), (r.event_time)) v(x))
       ELSE q.event_time_latest END AS event_time_latest
FROM {queue} q LEFT JOIN {records} r ON q.source_table = r.source_table AND q.status = 'Q'
UNION ALL
SELECT r.* FROM {records} r
WHERE NOT EXISTS (SELECT 1 FROM {queue} q WHERE q.source_table = r.source_table AND q.status = 'Q')"""


def claimed_queue_sql(queue: str, claims: str, as_of: str) -> str:
    """The queue after claims: their rows run since ``as_of``."""
    return f"""
SELECT q.source_table, q.target_table, q.where_clause, q.primary_key, q.event_time,
  CASE WHEN c.source_table IS NOT NULL THEN TIMESTAMP '{as_of}' ELSE q.trigger_time END AS trigger_time,
  q.strategy, q.lock_rows, CASE WHEN c.source_table IS NOT NULL THEN 'R' ELSE q.status END AS status,
  q.priority, q.event_time_latest
FROM {queue} q LEFT JOIN {claims} c ON q.source_table = c.source_table AND q.event_time = c.event_time"""


def claimed_history_sql(history: str, claims: str, as_of: str) -> str:
    """The history after claims: each has a running row, in the place of a finished one of the same key."""
    return f"""
SELECT * FROM {history} h
WHERE h.status = 'RUNNING'
   OR NOT EXISTS (SELECT 1 FROM {claims} c WHERE c.source_table = h.source_table AND c.event_time = h.event_time)
UNION ALL
SELECT c.source_table, c.target_table, c.where_clause, c.primary_key, 'RUNNING', c.event_time,
  TIMESTAMP '{as_of}', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), c.strategy, c.lock_rows, c.priority,
  CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
FROM {claims} c
WHERE NOT EXISTS (SELECT 1 FROM {history} h WHERE h.source_table = c.source_table AND h.event_time = c.event_time
                    AND h.status = 'RUNNING')"""


VIEWS["records"] = records_sql()
VIEWS["upserted"] = upserted_sql()
VIEWS["completions"] = """
SELECT source_table, event_time, CASE WHEN priority % 2 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  TIMESTAMP '2024-01-20 00:45:30' AS finish_time,
  round(date_diff('second', trigger_time, TIMESTAMP '2024-01-20 00:45:30') / 60.0, 2) AS duration_min,
  CAST(priority * 100 AS BIGINT) AS num_records,
  CASE WHEN priority % 2 = 0 THEN 'load failed: can''t reach source' ELSE '' END AS error
FROM queue WHERE status = 'R'"""

_DEPS = {
    "records": ["incoming", "attrs"], "upserted": ["queue", "records"], "completions": ["queue"],
    "feed": [], "attrs": [], "attrs_raw": [], "queue": ["feed", "attrs"],
    "history": ["feed", "queue"], "incoming": ["feed"], "load_source": [], "load_target": [],
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first), then ``extra``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in order]
    ctes += [f"{k} AS (\n{v}\n)" for k, v in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body.strip()


# The weight of a table whose slack (max_staleness - staleness, minutes) is over each limit.
TIERS = """(VALUES (60, 1), (45, 2), (30, 3), (15, 4), (10, 5), (5, 6), (3, 7), (2, 8), (1, 9), (0, 10), (-5, 15), (-10, 20))
  tiers(slack_over, weight)"""


def tier_sql(staleness: str) -> str:
    """The weight looked up in ``TIERS``: the least that applies, 25 beyond all, 0 before min_staleness."""
    return (f"if({staleness} < min_staleness, 0, coalesce((SELECT min(weight) FROM {TIERS} "
            f"WHERE max_staleness - {staleness} > slack_over), 25))")


TIER_SQL = f"CAST({tier_sql('staleness_m')} AS INTEGER)"


def staleness_sql(as_of: str) -> str:
    return (f"CAST(floor(date_diff('second', date_trunc('second', q.event_time), "
            f"date_trunc('second', TIMESTAMP '{as_of}')) / 60) AS BIGINT)")


def weighted_sql(as_of: str, source: str = "queue") -> str:
    """Queued rows of any weight with their weighted priority."""
    tier = tier_sql(staleness_sql(as_of))
    return f"""
SELECT q.* EXCLUDE (status, trigger_time, event_time_latest) REPLACE (CAST(q.priority * {tier} AS INTEGER) AS priority)
FROM {source} q JOIN attrs d USING (source_table) WHERE q.status = 'Q' AND q.priority > 0 AND {tier} > 0"""


def ranked_sql(weighted: str = "weighted") -> str:
    """A row's rank is the number of rows not behind it."""
    return f"""
SELECT a.*, (SELECT count(*) FROM {weighted} b WHERE (-b.priority, b.event_time, b.source_table)
                                                  <= (-a.priority, a.event_time, a.source_table)) AS rank
FROM {weighted} a"""


def _claims_sql(jdbc: int, staged: int, ranked: str = "ranked") -> str:
    return f"""
SELECT source_table, target_table, where_clause, primary_key, event_time, strategy, lock_rows, priority, rank,
  CASE WHEN strategy = 'WriteNOS' THEN 'WriteNOS' WHEN n <= {jdbc} THEN 'JDBC' ELSE 'WriteNOS' END AS worker
FROM (SELECT r.*, (SELECT count(*) FROM {ranked} r2 WHERE r2.strategy = r.strategy AND r2.rank <= r.rank) AS n
      FROM {ranked} r WHERE strategy IN ('JDBC', 'WriteNOS')) c
WHERE (strategy = 'WriteNOS' AND n <= {staged})
   OR (strategy = 'JDBC' AND n <= {jdbc} + {staged}
       - least({staged}, (SELECT count(*) FROM {ranked} WHERE strategy = 'WriteNOS')))"""


VIEWS["weighted"] = weighted_sql(RANK_AS_OF)
VIEWS["ranked"] = ranked_sql()
VIEWS["claims"] = _claims_sql(SLOTS["JDBC"], SLOTS["WriteNOS"])
_DEPS["weighted"] = ["queue", "attrs"]
_DEPS["ranked"] = ["weighted"]
_DEPS["claims"] = ["ranked"]
