"""Load planning: high-water marks, pending-row counts, transport and load mode.

The reference runs one MAX on the target and one COUNT on the source per
table in a driver loop. Here all tables of a grouped frame are planned in one
job: MAX is a partial+final aggregate, and the pending count joins the source
with the marks (one row per table; the planner broadcasts it when its measured
size allows, else AQE splits a skewed table's partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import name_parts, stage_path
from tidemark.schemas import DEFAULT_CUTOFF, DIRECT, STAGED


def high_water_marks(target: DataFrame, table_col: str, cdc_col: str) -> DataFrame:
    """Per table: the largest value of the change-tracking column in the target."""
    return target.groupBy(table_col).agg(F.max(cdc_col).alias("hwm"))


def where_for_mark(cdc_col: str, hwm: Column) -> Column:
    """``cdc_col >= 'mark'`` text, or '' when there is no mark (full load)."""
    return F.when(hwm.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(f"{cdc_col} >= '"), hwm.cast("string"), F.lit("'")))


def transport(hwm: Column, pending: Column, default_strategy: Column, cutoff: int) -> Column:
    """No mark -> the configured strategy; else direct below ``cutoff`` pending rows, staged at or above."""
    return (F.when(hwm.isNull(), default_strategy)
             .when(pending < F.lit(cutoff), F.lit(DIRECT))
             .otherwise(F.lit(STAGED)))


def cdc_plan(source: DataFrame, target: DataFrame, table_col: str, cdc_col: str,
             default_strategy: str | Column = STAGED, cutoff: int = DEFAULT_CUTOFF) -> DataFrame:
    """One plan row per source table: hwm, pending_rows (rows at or above it), strategy, where_clause.

    One scan of each side: the target is reduced to its marks (partial and final
    MAX), the source rows are tagged with their table's mark and counted in the
    same grouped aggregate that lists the tables, so only aggregated rows are
    shuffled; a table holding most rows costs one partial row per task.
    """
    marks = high_water_marks(target, table_col, cdc_col)
    tagged = source.select(table_col, cdc_col).join(marks, table_col, "left")
    p = tagged.groupBy(table_col).agg(
        F.max("hwm").alias("hwm"),
        F.count(F.when(F.col(cdc_col) >= F.col("hwm"), 1)).alias("_tm_pending"))
    hwm = F.col("hwm")
    pend = F.when(hwm.isNotNull(), F.col("_tm_pending"))
    dflt = default_strategy if isinstance(default_strategy, Column) else F.lit(default_strategy)
    return p.select(table_col, "hwm", pend.alias("pending_rows"),
                    transport(hwm, pend, dflt, cutoff).alias("strategy"),
                    where_for_mark(cdc_col, hwm).alias("where_clause"))


def cdc_extract(source: DataFrame, plan: DataFrame, table_col: str, cdc_col: str) -> DataFrame:
    """Source rows at or above their table's mark (all rows of a table without one).

    ``plan`` needs the table and its ``hwm``: a ``cdc_plan``, or just ``high_water_marks``.
    """
    marks = plan.select(table_col, F.col("hwm").alias("_tm_hwm"))
    j = source.join(marks, table_col, "left")
    return j.where(F.col("_tm_hwm").isNull() | (F.col(cdc_col) >= F.col("_tm_hwm"))).select(*source.columns)


def extract_where(source: DataFrame, where_clause: str | None) -> DataFrame:
    """One table: apply the planned predicate text (pushed to the scan)."""
    return source.where(F.expr(where_clause)) if where_clause else source


def load_mode(primary_key: Column, where_clause: Column) -> Column:
    """Primary key -> merge; else a predicate -> replace_where; else overwrite."""
    return (F.when(F.coalesce(primary_key, F.lit("")) != "", F.lit("merge"))
             .when(F.coalesce(where_clause, F.lit("")) != "", F.lit("replace_where"))
             .otherwise(F.lit("overwrite")))


def load_mode_plan(rows: DataFrame, stage_root: str) -> DataFrame:
    """Per queued row: validated upper-case names, load mode, truncate-first flag, stage dir.

    Source names must have exactly 2 parts and targets exactly 3. Staged loads
    without a predicate truncate the target first; they export to a
    per-table folder ``stage_root/<catalog>/<schema>__<table>``.
    """
    src, tgt = F.upper(F.col("source_table")), F.upper(F.col("target_table"))
    staged = F.col("strategy") == STAGED
    return rows.select(
        src.alias("source_table"), tgt.alias("target_table"), "strategy",
        load_mode(F.col("primary_key"), F.col("where_clause")).alias("mode"),
        (staged & (F.coalesce(F.col("where_clause"), F.lit("")) == "")).alias("truncate_first"),
        F.when(staged, stage_path(stage_root, tgt, src)).alias("stage_dir"),
        ((name_parts(src) == 2) & (name_parts(tgt) == 3)).alias("names_ok"),
    )
