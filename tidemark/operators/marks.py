"""Load plans of unlike tables: each with its own path, change column and type.

All high-water marks come from one job, a union of one-row aggregates, read
through Spark's v2 Parquet reader with aggregate push-down: where the type
allows (integers, floats, dates, booleans) a MAX only reads file footers. The
pending counts are a second such union, whose predicates prune row groups. A
table that cannot be planned gets an error text and its configured strategy,
and does not hold up the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.planning import transport
from tidemark.schemas import DEFAULT_CUTOFF


@dataclass(frozen=True)
class TableSpec:
    """A table to plan: where its source and target are stored, and its change column (none: a full load)."""
    source_table: str
    source_path: str
    target_path: str
    cdc_column: str | None
    strategy: str


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own whose Parquet reads push MAX, MIN and COUNT to the file footers."""
    own = spark.newSession()
    v1 = [s for s in own.conf.get("spark.sql.sources.useV1SourceList", "").split(",") if s and s != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def table_mark(session: SparkSession, path: str, column: str) -> DataFrame:
    """One row: the largest value of a column, as text (the same text Spark casts back)."""
    return session.read.parquet(path).agg(F.max(f"`{column}`").cast("string").alias("value"))


def pending_count(session: SparkSession, path: str, column: str, mark: str) -> DataFrame:
    """One row: the number of rows at or above a mark, as text."""
    return (session.read.parquet(path).where(f"`{column}` >= '{mark}'")
            .agg(F.count(F.lit(1)).cast("string").alias("value")))


def _reason(e: Exception) -> str:
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    return f"{type(e).__name__}: {condition or e}"


def _each(builds: dict[str, Callable[[], DataFrame]]) -> dict[str, tuple[str | None, str | None]]:
    """``(value, error)`` of one-row frames by name: in one job if all can be run, else each on its own."""
    plans: dict[str, DataFrame] = {}
    out: dict[str, tuple[str | None, str | None]] = {}
    for name, build in builds.items():
        try:
            plans[name] = build().select(F.lit(name).alias("name"), "value")
            plans[name].schema  # resolves paths and columns
        except Exception as e:  # noqa: BLE001 - kept as the table's error
            plans.pop(name, None)
            out[name] = (None, _reason(e))
    if not plans:
        return out
    frames = list(plans.values())
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    try:
        return out | {r["name"]: (r["value"], None) for r in union.collect()}
    except Exception:  # noqa: BLE001 - some table fails while it is read: find out which
        for name, f in plans.items():
            try:
                out[name] = (f.first()["value"], None)
            except Exception as e:  # noqa: BLE001
                out[name] = (None, _reason(e))
    return out


def plan_tables(spark: SparkSession, tables: Sequence[TableSpec], cutoff: int = DEFAULT_CUTOFF) -> DataFrame:
    """One plan row per table: ``source_table, strategy, where_clause, hwm, pending_rows, error``.

    Without a change column, without rows in the target, or after an error, the
    configured strategy and a full load; else direct below ``cutoff`` pending rows, staged at
    or above. The driver sees two values a table.
    """
    session = footer_session(spark)
    with_mark = {t.source_table: t for t in tables if t.cdc_column}
    marks = _each({n: lambda t=t: table_mark(session, t.target_path, t.cdc_column) for n, t in with_mark.items()})
    known = {n: t for n, t in with_mark.items() if marks[n][0] is not None}
    counts = _each({n: lambda n=n, t=t: pending_count(session, t.source_path, t.cdc_column, marks[n][0])
                    for n, t in known.items()})
    rows = []
    for t in tables:
        mark, error = marks.get(t.source_table, (None, None))
        pending, failed = counts.get(t.source_table, (None, None))
        error = error or failed
        rows.append((t.source_table, t.strategy, t.cdc_column or "", None if error else mark,
                     None if error or pending is None else int(pending), error))
    df = spark.createDataFrame(rows, "source_table string, given string, cdc_column string, hwm string, "
                                     "pending_rows bigint, error string")
    hwm = F.col("hwm")
    where = F.when(hwm.isNull(), F.lit("")).otherwise(F.concat("cdc_column", F.lit(" >= '"), hwm, F.lit("'")))
    return df.select("source_table", transport(hwm, F.col("pending_rows"), F.col("given"), cutoff).alias("strategy"),
                     where.alias("where_clause"), "hwm", "pending_rows", "error")
