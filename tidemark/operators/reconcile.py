"""Row-count reconciliation and load reports.

All counts of one check come from a single aggregation over a tagged union of
the inputs (no joins of one-row frames, no driver round trips).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeexpr import report_time, seconds_between
from tidemark.operators.loading import key_columns, predicate
from tidemark.schemas import DEFAULT_ZONE

_BEFORE, _PAYLOAD, _AFTER, _DELETED, _MATCHED, _MISSING = range(6)


def _tag(df: DataFrame, tag: int) -> DataFrame:
    return df.select(F.lit(tag).alias("_tm_tag"))


def count_reconcile(mode: str, payload: DataFrame, before: DataFrame, after: DataFrame, *,
                    where: str | Column | None = None,
                    primary_key: str | Sequence[str] | None = None) -> DataFrame:
    """One row: mode, payload_rows, target_before, target_after, expected_after, ok.

    Expected rows after the load, by mode: overwrite = payload; replace_where =
    before - deleted + payload; merge = before - matched + payload, and every
    payload key must be present afterwards.
    """
    parts = [_tag(before, _BEFORE), _tag(payload, _PAYLOAD), _tag(after, _AFTER)]
    if mode == "replace_where":
        parts.append(_tag(before.where(F.coalesce(predicate(where), F.lit(False))), _DELETED))
    if mode == "merge":
        keys = key_columns(primary_key)
        pk = payload.select(*keys)
        parts.append(_tag(before.join(pk, keys, "left_semi"), _MATCHED))
        # rows with a null key are inserted and cannot be found again by key
        parts.append(_tag(pk.dropna(subset=keys).join(after.select(*keys), keys, "left_anti"), _MISSING))
    tagged = parts[0]
    for p in parts[1:]:
        tagged = tagged.unionByName(p)

    def n(tag: int) -> Column:
        return F.count(F.when(F.col("_tm_tag") == tag, 1))

    c = tagged.agg(n(_BEFORE).alias("target_before"), n(_PAYLOAD).alias("payload_rows"),
                   n(_AFTER).alias("target_after"), n(_DELETED).alias("_tm_deleted"),
                   n(_MATCHED).alias("_tm_matched"), n(_MISSING).alias("_tm_missing"))
    if mode in ("overwrite", "truncate_append"):
        expected = F.col("payload_rows")
    elif mode == "replace_where":
        expected = F.col("target_before") - F.col("_tm_deleted") + F.col("payload_rows")
    elif mode == "merge":
        expected = F.col("target_before") - F.col("_tm_matched") + F.col("payload_rows")
    else:
        raise ValueError(f"unknown load mode {mode!r}")
    ok = (F.col("target_after") == expected) & (F.col("_tm_missing") == 0)
    return c.select(F.lit(mode).alias("mode"), "payload_rows", "target_before", "target_after",
                    expected.alias("expected_after"), ok.alias("ok"))


def table_checksum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows and an order-free content checksum (sum of 64-bit row hashes)."""
    cols = list(columns or df.columns)
    h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)")
                  .alias("checksum"))


def content_reconcile(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None,
                      by: str | None = None) -> DataFrame:
    """Post-load validation: same rows and same content checksum on both sides.

    One aggregate over a tagged union (grouped by table when ``by`` names the
    table column); the checksum is the sum of 64-bit row hashes, so it does not
    depend on row order or partitioning. The source is compared in the target's
    types, and a null counts by its place.
    """
    cols = [c for c in (columns or target.columns) if c != by]
    kinds = {f.name: f.dataType for f in target.schema.fields}

    def hashed(df: DataFrame, tag: int) -> DataFrame:
        keys = [F.col(by)] if by else []
        return df.select(*keys, F.lit(tag).alias("_tm_tag"),
                         F.xxhash64(*[x for c in cols for x in (F.col(c).cast(kinds[c]), F.col(c).isNull())])
                         .cast("decimal(38,0)").alias("_tm_h"))

    u = hashed(source, 0).unionByName(hashed(target, 1))

    def side(tag: int, what: str):
        hit = F.col("_tm_tag") == tag
        if what == "rows":
            return F.count(F.when(hit, 1))
        return F.coalesce(F.sum(F.when(hit, F.col("_tm_h"))), F.lit(0)).cast("decimal(38,0)")

    aggs = [side(0, "rows").alias("source_rows"), side(0, "sum").alias("source_checksum"),
            side(1, "rows").alias("target_rows"), side(1, "sum").alias("target_checksum")]
    out = u.groupBy(by).agg(*aggs) if by else u.agg(*aggs)
    return out.withColumn("ok", (F.col("source_rows") == F.col("target_rows"))
                          & (F.col("source_checksum") == F.col("target_checksum")))


def duration_minutes(start: Column, end: Column) -> Column:
    """round((end - start) / 60, 2) in minutes, from whole seconds."""
    return F.round(seconds_between(start, end) / F.lit(60.0), 2)


def load_report(history: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Report rows for finished loads: table, strategy, status, start, end, duration,
    num_records, error, and the CSV report line with local times."""
    done = history.where(F.col("finish_time").isNotNull())
    dur = duration_minutes(F.col("trigger_time"), F.col("finish_time"))
    start_txt, end_txt = report_time(F.col("trigger_time"), zone), report_time(F.col("finish_time"), zone)
    strategy = F.lower(F.col("strategy"))
    err = F.trim(F.coalesce(F.col("error"), F.lit("")))
    line = F.concat_ws(",", F.col("source_table"), strategy, F.col("status"), start_txt, end_txt,
                       F.format_string("%.2f", dur), F.col("num_records").cast("string"), err)
    return done.select(
        F.col("source_table").alias("table"), strategy.alias("strategy"), "status",
        F.col("trigger_time").alias("start"), F.col("finish_time").alias("end"),
        dur.alias("duration_min"), "num_records", err.alias("error"), line.alias("line"),
    )
