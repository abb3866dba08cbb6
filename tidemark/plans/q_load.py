"""Planning and load queries: cdc plan, extract, load modes, projections, loads, exports, counts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import loading, planning, projection
from tidemark.operators.projection import ColumnSpec
from tidemark.operators.reconcile import content_reconcile, count_reconcile
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import register
from tidemark.sinks import tables
from tidemark.sources.staged import staged_scan

# Fixed values of the load fixtures.
TABLE_COL, CDC_COL = "o_orderpriority", "o_orderdate"
CDC_SHARE = 20  # one in so many of the source rows: direct below, staged at or above
REPLACE_WHERE = "o_orderdate >= '1998-01-01'"
MERGE_KEY = "o_orderkey"
STAGE_ROOT = "sync-stage"
EXPORT_FILE_ROWS = 1000
# The source dictionary of `orders` as the source system would describe it.
ORDERS_DICTIONARY = [
    ColumnSpec("o_orderkey", "I8"),
    ColumnSpec("o_custkey", "I8"),
    ColumnSpec("o_orderstatus", "CF", format="X(1)"),
    ColumnSpec("o_totalprice", "D", digits=15, fraction=2),
    ColumnSpec("o_orderdate", "DA"),
    ColumnSpec("o_orderpriority", "CV"),
]

_TYPED_ORDERS = """
SELECT o_orderkey, o_custkey, substr(o_orderstatus, 1, 1) AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders"""


def _orders_target():
    return projection.target_schema_from_dictionary(ORDERS_DICTIONARY)


def _plan(fx: Fixtures) -> DataFrame:
    return planning.cdc_plan(fx.load_source, fx.load_target, TABLE_COL, CDC_COL, "WriteNOS",
                             fx.load_source.count() // CDC_SHARE)


def _read_back(df: DataFrame, name: str) -> DataFrame:
    return df.sparkSession.read.parquet(tables.publish(df, name=name))


_MARKS = {"marks": "SELECT o_orderpriority, max(o_orderdate) AS hwm FROM load_target GROUP BY o_orderpriority"}


@register("cdc_plan", O.with_views(f"""
SELECT o_orderpriority, hwm, pending_rows,
  CASE WHEN hwm IS NULL THEN 'WriteNOS' WHEN pending_rows < (SELECT count(*) // {CDC_SHARE} FROM load_source) THEN 'JDBC' ELSE 'WriteNOS' END AS strategy,
  CASE WHEN hwm IS NULL THEN '' ELSE 'o_orderdate >= ''' || CAST(hwm AS VARCHAR) || '''' END AS where_clause
FROM (
  SELECT s.o_orderpriority, m.hwm,
    CASE WHEN m.hwm IS NULL THEN NULL ELSE (SELECT count(*) FROM load_source x
      WHERE x.o_orderpriority = s.o_orderpriority AND x.o_orderdate >= m.hwm) END AS pending_rows
  FROM (SELECT DISTINCT o_orderpriority FROM load_source) s LEFT JOIN marks m ON m.o_orderpriority = s.o_orderpriority
) p""", "load_source", "load_target", extra=_MARKS))
def q_cdc_plan(spark, sf_dir):
    return _plan(Fixtures(spark, sf_dir))


@register("cdc_extract", O.with_views("""
SELECT s.* FROM load_source s LEFT JOIN marks m ON m.o_orderpriority = s.o_orderpriority
WHERE m.hwm IS NULL OR s.o_orderdate >= m.hwm""", "load_source", "load_target", extra=_MARKS))
def q_cdc_extract(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    marks = planning.high_water_marks(fx.load_target, TABLE_COL, CDC_COL)  # the extract needs no counts
    return planning.cdc_extract(fx.load_source, marks, TABLE_COL, CDC_COL)


def _sql_part(x: str, i: int) -> str:
    return f"list_element(string_split({x}, '.'), {i})"


@register("load_mode_plan", O.with_views(f"""
SELECT upper(source_table) AS source_table, upper(target_table) AS target_table, strategy,
  CASE WHEN coalesce(primary_key, '') <> '' THEN 'merge' WHEN coalesce(where_clause, '') <> '' THEN 'replace_where'
       ELSE 'overwrite' END AS mode,
  strategy = 'WriteNOS' AND coalesce(where_clause, '') = '' AS truncate_first,
  CASE WHEN strategy = 'WriteNOS' THEN concat_ws('/', '{STAGE_ROOT}', {_sql_part('upper(target_table)', 1)},
       concat_ws('__', {_sql_part('upper(source_table)', 1)}, {_sql_part('upper(source_table)', 2)},
                 {_sql_part('upper(source_table)', 3)})) END AS stage_dir,
  len(string_split(source_table, '.')) = 2 AND len(string_split(target_table, '.')) = 3 AS names_ok
FROM queue""", "queue"))
def q_load_mode_plan(spark, sf_dir):
    return planning.load_mode_plan(Fixtures(spark, sf_dir).queue, STAGE_ROOT)


@register("source_text_projection", O.with_views("""
SELECT o_orderkey, o_custkey, substr(o_orderstatus, 1, 1) AS o_orderstatus,
  CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  o_orderpriority
FROM orders"""))
def q_source_text_projection(spark, sf_dir):
    return projection.source_text_projection(Fixtures(spark, sf_dir).table("orders"), ORDERS_DICTIONARY)


@register("typed_projection", O.with_views(_TYPED_ORDERS))
def q_typed_projection(spark, sf_dir):
    text = projection.source_text_projection(Fixtures(spark, sf_dir).table("orders"), ORDERS_DICTIONARY)
    return projection.typed_projection(text, _orders_target())


@register("staged_scan", O.with_views(_TYPED_ORDERS))
def q_staged_scan(spark, sf_dir):
    text = projection.source_text_projection(Fixtures(spark, sf_dir).table("orders"), ORDERS_DICTIONARY)
    path, _ = tables.export_stage(text, max_records_per_file=EXPORT_FILE_ROWS)
    return staged_scan(spark, path, _orders_target())


@register("stage_export_counts", O.with_views(f"""
SELECT count(*) AS records, count(*) AS written, max(1) <= {EXPORT_FILE_ROWS} AS files_within_limit
FROM load_source""", "load_source"))
def q_stage_export_counts(spark, sf_dir):
    src = Fixtures(spark, sf_dir).load_source
    path, written = tables.export_stage(src, max_records_per_file=EXPORT_FILE_ROWS)
    per_file = tables.stage_file_counts(spark, path)
    return per_file.agg(F.sum("records").cast("bigint").alias("records"),
                        F.lit(written).cast("bigint").alias("written"),
                        (F.max("records") <= EXPORT_FILE_ROWS).alias("files_within_limit"))


@register("load_overwrite", O.with_views("SELECT * FROM load_source", "load_source"))
def q_load_overwrite(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _read_back(loading.overwrite(fx.load_source, fx.load_target.schema), "load_overwrite")


@register("load_truncate_append", O.with_views("SELECT * FROM load_source", "load_source"))
def q_load_truncate_append(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    target = fx.load_target
    path = tables.publish(target, name="load_truncate_append")
    tables.truncate_load(spark, path, loading.truncate_append(fx.load_source, target.schema))
    return spark.read.parquet(path)


@register("load_replace_where", O.with_views(f"""
SELECT * FROM load_target WHERE NOT coalesce({REPLACE_WHERE}, false)
UNION ALL
SELECT * FROM load_source WHERE {REPLACE_WHERE}""", "load_source", "load_target"))
def q_load_replace_where(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _read_back(loading.replace_where(fx.load_target, fx.load_source, REPLACE_WHERE), "load_replace_where")


_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("load_merge_pk", O.with_views(
    "SELECT " + ", ".join(f"CASE WHEN s._in THEN s.{c} ELSE t.{c} END AS {c}" for c in _COLS) + """
FROM load_target t FULL OUTER JOIN (SELECT *, true AS _in FROM load_source) s ON t.o_orderkey = s.o_orderkey""",
    "load_source", "load_target"))
def q_load_merge_pk(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return _read_back(loading.merge_pk(fx.load_target, fx.load_source, MERGE_KEY), "load_merge_pk")


@register("row_count_reconcile", O.with_views(f"""
SELECT 'overwrite' AS mode, (SELECT count(*) FROM load_source) AS payload_rows,
  (SELECT count(*) FROM load_target) AS target_before, (SELECT count(*) FROM load_source) AS target_after,
  (SELECT count(*) FROM load_source) AS expected_after, true AS ok
UNION ALL
SELECT 'replace_where', p, b, b - d + p, b - d + p, true FROM (
  SELECT (SELECT count(*) FROM load_source WHERE {REPLACE_WHERE}) AS p, (SELECT count(*) FROM load_target) AS b,
         (SELECT count(*) FROM load_target WHERE {REPLACE_WHERE}) AS d) x
UNION ALL
SELECT 'merge', p, b, a, b - m + p, a = b - m + p FROM (
  SELECT (SELECT count(*) FROM load_source) AS p, (SELECT count(*) FROM load_target) AS b,
         (SELECT count(*) FROM load_target t WHERE t.o_orderkey IN (SELECT o_orderkey FROM load_source)) AS m,
         (SELECT count(*) FROM (SELECT o_orderkey FROM load_target UNION ALL SELECT o_orderkey FROM load_source
            WHERE o_orderkey NOT IN (SELECT o_orderkey FROM load_target))) AS a) y""", "load_source", "load_target"))
def q_row_count_reconcile(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    src, tgt = fx.load_source, fx.load_target
    loads = [loading.overwrite(src, tgt.schema), loading.replace_where(tgt, src, REPLACE_WHERE), loading.merge_pk(tgt, src, MERGE_KEY)]
    with ThreadPoolExecutor(len(loads)) as pool:  # three loads at a time; what is counted is what was written
        after = list(pool.map(lambda df: _read_back(df, "reconcile"), loads))
    over = count_reconcile("overwrite", src, tgt, after[0])
    rw = count_reconcile("replace_where", src.where(F.expr(REPLACE_WHERE)), tgt, after[1], where=REPLACE_WHERE)
    mg = count_reconcile("merge", src, tgt, after[2], primary_key=MERGE_KEY)
    return over.unionByName(rw).unionByName(mg)


_DIFFERENT = " EXCEPT ALL ".join("SELECT {} FROM {}".format(", ".join(_COLS), t) for t in ("{}", "{}"))


@register("content_reconcile", O.with_views(f"""
SELECT o_custkey, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows, o_custkey NOT IN (
    SELECT o_custkey FROM ({_DIFFERENT.format("load_source", "load_target")}) a
    UNION SELECT o_custkey FROM ({_DIFFERENT.format("load_target", "load_source")}) b) AS ok
FROM (SELECT o_custkey, count(*) AS n FROM load_source GROUP BY o_custkey) s
FULL JOIN (SELECT o_custkey, count(*) AS n FROM load_target GROUP BY o_custkey) t USING (o_custkey)""",
                                            "load_source", "load_target"))
def q_content_reconcile(spark, sf_dir):
    """Rows and content of both sides per customer (standing for a table): agreeing, changed and missing rows occur."""
    fx = Fixtures(spark, sf_dir)
    return content_reconcile(fx.load_source, fx.load_target, columns=_COLS, by="o_custkey").select(
        "o_custkey", "source_rows", "target_rows", "ok")


# ---------------------------------------------------------------- whole load flows
FLOW_WHERE = "o_orderdate >= '1999-06-01'"
SOURCE_DICTIONARY = [
    ColumnSpec("o_orderkey", "I8"),
    ColumnSpec("o_custkey", "I8"),
    ColumnSpec("o_orderstatus", "CF", format="X(1)"),
    ColumnSpec("o_totalprice", "F"),
    ColumnSpec("o_orderdate", "TS", max_length=19),
    ColumnSpec("o_orderpriority", "CV"),
]


@register("load_flow_direct", O.with_views(
    "SELECT " + ", ".join(f"CASE WHEN s._in THEN s.{c} ELSE t.{c} END AS {c}" for c in _COLS) + f"""
FROM load_target t FULL OUTER JOIN (SELECT *, true AS _in FROM load_source WHERE {FLOW_WHERE}) s
  ON t.o_orderkey = s.o_orderkey""", "load_source", "load_target"))
def q_load_flow_direct(spark, sf_dir):
    """Direct load with a key and a predicate: the predicate narrows the extract, the key merges."""
    from tidemark.plans.flows import LoadPlan, run_load
    fx = Fixtures(spark, sf_dir)
    res = run_load(spark, fx.load_source, fx.load_target,
                   LoadPlan("SRC.ORDERS", "JDBC", where_clause=FLOW_WHERE, primary_key=MERGE_KEY))
    if res.path is None:
        raise RuntimeError(res.report.first().error)
    return spark.read.parquet(res.path)


@register("load_flow_staged", O.with_views(f"""
SELECT * FROM load_target WHERE NOT coalesce({REPLACE_WHERE}, false)
UNION ALL
SELECT * FROM load_source WHERE {REPLACE_WHERE}""", "load_source", "load_target"))
def q_load_flow_staged(spark, sf_dir):
    """Staged load with a predicate: export as text, read back typed, delete + append."""
    from tidemark.plans.flows import LoadPlan, run_load
    fx = Fixtures(spark, sf_dir)
    res = run_load(spark, fx.load_source, fx.load_target, LoadPlan("SRC.ORDERS", "WriteNOS", REPLACE_WHERE),
                   dictionary=SOURCE_DICTIONARY, max_records_per_file=EXPORT_FILE_ROWS)
    if res.path is None:
        raise RuntimeError(res.report.first().error)
    return spark.read.parquet(res.path)


@register("load_replace_where_partitions", O.with_views(f"""
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_orderyear FROM load_target WHERE NOT coalesce({REPLACE_WHERE}, false)
UNION ALL
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_orderyear FROM load_source WHERE {REPLACE_WHERE}""",
                                                        "load_source", "load_target"))
def q_load_replace_where_partitions(spark, sf_dir):
    """Replace-where on a target partitioned by order year: only the touched years are rewritten."""
    fx = Fixtures(spark, sf_dir)
    year = F.year("o_orderdate").cast("int").alias("o_orderyear")
    path = tables.publish(fx.load_target.select("*", year), name="load_partitioned", partition_by=["o_orderyear"])
    tables.replace_where_in_place(spark, path, fx.load_source.select("*", year), REPLACE_WHERE, ["o_orderyear"])
    return spark.read.parquet(path)


@register("load_merge_pk_partitions", O.with_views(
    "SELECT " + ", ".join(f"CASE WHEN s._in THEN s.{c} ELSE t.{c} END AS {c}" for c in _COLS) + """,
  CAST(year(CASE WHEN s._in THEN s.o_orderdate ELSE t.o_orderdate END) AS INTEGER) AS o_orderyear
FROM load_target t FULL OUTER JOIN (SELECT *, true AS _in FROM load_source) s ON t.o_orderkey = s.o_orderkey""",
    "load_source", "load_target"))
def q_load_merge_pk_partitions(spark, sf_dir):
    """Key merge into a target partitioned by order year, rewriting only the years the payload touches."""
    fx = Fixtures(spark, sf_dir)
    year = F.year("o_orderdate").cast("int").alias("o_orderyear")
    path = tables.publish(fx.load_target.select("*", year), name="load_partitioned", partition_by=["o_orderyear"])
    tables.merge_in_place(spark, path, fx.load_source.select("*", year), MERGE_KEY, ["o_orderyear"])
    return spark.read.parquet(path)
