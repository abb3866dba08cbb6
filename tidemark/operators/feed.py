"""Feed operators: coalesce, attribute lookup, enrichment, validation, enqueue records.

The reference walks feed rows in a driver loop; here all tables are handled by
one grouped plan. Per-table work is pre-aggregated before any join, so a table
with a third of all feed rows costs one partial-aggregate row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import empty_to_null, name_parts, parse_flag, qualify
from tidemark.schemas import QUEUE_COLUMNS, QUEUED, STAGED, STRATEGIES


def coalesce_feed(feed: DataFrame) -> DataFrame:
    """One row per table: first and latest event time, and the event count."""
    return feed.groupBy("source_table").agg(
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("latest_event_time"),
        F.count(F.lit(1)).alias("events"),
    )


def table_names(feed: DataFrame) -> DataFrame:
    """Distinct table names of a feed (partial aggregation before the shuffle)."""
    return feed.select("source_table").distinct()


def enabled(attrs: DataFrame) -> DataFrame:
    """Attribute rows with ``disabled = false`` (null counts as not enabled, like SQL)."""
    return attrs.where(F.col("disabled") == F.lit(False))


def table_attrs(attrs: DataFrame, feed: DataFrame) -> DataFrame:
    """Enabled attributes of the tables named in the feed (IN-list as a semi join)."""
    return enabled(attrs).join(table_names(feed), "source_table", "left_semi")


def enrich(feed: DataFrame, attrs: DataFrame, salt_buckets: int | None = None) -> DataFrame:
    """Feed rows with their enabled attributes; rows without attributes drop out.

    Attributes hold one row per table, so the planner normally broadcasts
    them, or AQE splits a hot table's partition. ``salt_buckets`` forces a
    salted join instead: each feed row goes to one of N buckets by a hash of
    the row (deterministic, so a retried task places it the same way) and each
    attribute row is replicated to all N buckets, which spreads a table
    holding a large share of the feed over N tasks.
    """
    a = enabled(attrs).drop("disabled")
    if not salt_buckets:
        return feed.join(a, "source_table")
    n = int(salt_buckets)
    salted = feed.withColumn("_tm_salt", F.pmod(F.xxhash64(*[F.col(c) for c in feed.columns]), F.lit(n)))
    spread = a.withColumn("_tm_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
    return salted.join(spread, ["source_table", "_tm_salt"]).drop("_tm_salt")


ATTR_FIELDS = ["source_table", "target_table", "ingestion_strategy", "cdc_watermark", "primary_key",
               "strategy", "disabled", "priority", "min_staleness", "max_staleness"]


def attrs_from_lines(lines: DataFrame, column: str = "value", sep: str = ",") -> DataFrame:
    """Attribute rows from delimited text lines (e.g. ``spark.read.text``), all fields as text.

    A field in double quotes may hold the separator, as a composite primary key
    does. Empty fields become null; ``_tm_fields`` is the number of fields, or 0
    for a line with another number, which ``validate_attrs`` rejects.
    """
    schema = ", ".join(f"{name} string" for name in [*ATTR_FIELDS, "_tm_wrong"])
    row = F.from_csv(F.col(column), schema, {"sep": sep, "columnNameOfCorruptRecord": "_tm_wrong"})
    cols = [empty_to_null(F.trim(F.col(f"_tm_line.{name}"))).alias(name) for name in ATTR_FIELDS]
    whole = (F.trim(F.col(column)) != "") & F.col("_tm_line").isNotNull() & F.col("_tm_line._tm_wrong").isNull()
    return lines.select(column, row.alias("_tm_line")).select(
        *cols, F.when(whole, len(ATTR_FIELDS)).otherwise(0).alias("_tm_fields"))


def _checked(df: DataFrame, copies) -> DataFrame:
    """Typed attribute columns of ``df`` plus ``valid`` and ``reject_reason``."""
    src = F.col("source_table")
    tgt = F.coalesce(empty_to_null(F.col("target_table")), src)
    disabled_type = df.schema["disabled"].dataType
    if isinstance(disabled_type, T.BooleanType):
        disabled, disabled_ok = F.col("disabled"), F.lit(True)
    else:
        disabled = parse_flag(F.col("disabled"))
        disabled_ok = disabled.isNotNull()
    priority = F.col("priority").try_cast("int")
    min_st, max_st = F.col("min_staleness").try_cast("int"), F.col("max_staleness").try_cast("int")
    arity = (F.when(F.col("_tm_fields") != len(ATTR_FIELDS), F.lit(f"line must have {len(ATTR_FIELDS)} fields"))
             if "_tm_fields" in df.columns else F.lit(None).cast("string"))
    reasons = F.concat_ws("; ", arity,
        F.when(~name_parts(src).isin(2, 3), F.lit("source_table must have 2 or 3 name parts")),
        F.when(~name_parts(tgt).isin(2, 3), F.lit("target_table must have 2 or 3 name parts")),
        F.when(~F.coalesce(F.col("strategy").isin(*STRATEGIES), F.lit(False)),
               F.lit("strategy must be TPT, WriteNOS or JDBC")),
        F.when(~disabled_ok, F.lit("disabled must be true or false")),
        F.when(priority.isNull(), F.lit("priority is required")),
        F.when(max_st.isNull(), F.lit("max_staleness is required")),
        F.when(F.col("min_staleness").isNotNull() & min_st.isNull(), F.lit("min_staleness must be a number")),
        F.when(copies > 1, F.lit("duplicate source_table")),
    )
    return df.select(
        src.alias("source_table"), tgt.alias("target_table"), "ingestion_strategy", "cdc_watermark",
        "primary_key", "strategy", disabled.alias("disabled"), priority.alias("priority"),
        F.coalesce(min_st, F.lit(0)).alias("min_staleness"),
        max_st.alias("max_staleness"),
        (reasons == "").alias("valid"), empty_to_null(reasons).alias("reject_reason"),
    )


def validate_attrs(raw: DataFrame) -> DataFrame:
    """Typed attribute rows plus ``valid`` and ``reject_reason`` (null when valid).

    Rules: source and target have 2 or 3 name parts (empty target falls back to
    the source), strategy is one of TPT / WriteNOS / JDBC, ``disabled`` is a
    boolean or 'true'/'false' text, priority and max_staleness are given, a
    missing min_staleness is 0, and a source_table appears once.
    """
    dups = raw.groupBy("source_table").agg(F.count(F.lit(1)).alias("_tm_copies"))
    return _checked(raw.join(dups, "source_table", "left"), F.col("_tm_copies"))


def _not_disabled(attrs: DataFrame) -> DataFrame:
    """Rows that do not say they are disabled (a flag that cannot be read does not)."""
    flag = F.col("disabled")
    if not isinstance(attrs.schema["disabled"].dataType, T.BooleanType):
        return attrs.where(~F.coalesce(parse_flag(flag), F.lit(False)))
    return attrs.where(flag == F.lit(False))


def lookup_attrs(attrs: DataFrame) -> DataFrame:
    """One checked row per table that is not disabled: typed columns, ``valid``, ``reject_reason``.

    A table that stands there more than once is one rejected row, never two
    queue records. One grouping by the table, whose placement the join that
    follows uses again.
    """
    own = _not_disabled(attrs)
    rest = [c for c in own.columns if c != "source_table"]
    one = own.groupBy("source_table").agg(F.count(F.lit(1)).alias("_tm_copies"), F.min(F.struct(*rest)).alias("_tm_row"))
    return _checked(one.select("source_table", "_tm_row.*", "_tm_copies"), F.col("_tm_copies"))


def enqueue_rejects(feed: DataFrame, attrs: DataFrame) -> DataFrame:
    """Tables of a feed that are not enqueued because their attributes are no good: ``source_table, reject_reason``."""
    return (lookup_attrs(attrs).where(~F.col("valid")).join(table_names(feed), "source_table", "left_semi")
            .select("source_table", "reject_reason"))


def enqueue_records(coalesced: DataFrame, attrs: DataFrame, catalog: str,
                    plan: DataFrame | None = None) -> DataFrame:
    """Queue records (full queue schema) for coalesced feed rows with enabled attributes.

    Target falls back to the source and gets the catalog prefix unless it has
    3 parts. ``plan`` (source_table, strategy, where_clause), when given,
    overrides the configured strategy and sets the predicate (see planning).
    Attributes are checked here: tables whose row is not valid, or that have
    several, get no record (``enqueue_rejects`` lists them).
    """
    a = lookup_attrs(attrs).where("valid").select("source_table", F.col("target_table").alias("_tm_target"),
                              F.col("primary_key").alias("_tm_pk"), F.col("strategy").alias("_tm_strategy"),
                              F.col("priority").alias("_tm_priority"))
    j = coalesced.join(a, "source_table")
    strategy, where = F.col("_tm_strategy"), F.lit("")
    if plan is not None:
        p = plan.select("source_table", F.col("strategy").alias("_tm_plan_strategy"),
                        F.col("where_clause").alias("_tm_plan_where"))
        j = j.join(p, "source_table", "left")
        strategy = F.coalesce(F.col("_tm_plan_strategy"), strategy)
        where = F.coalesce(F.col("_tm_plan_where"), where)
    target = qualify(F.coalesce(empty_to_null(F.col("_tm_target")), F.col("source_table")), catalog)
    out = j.select(
        "source_table", target.alias("target_table"), where.alias("where_clause"),
        F.coalesce(F.col("_tm_pk"), F.lit("")).alias("primary_key"),
        F.col("first_event_time").alias("event_time"),
        F.lit(None).cast("timestamp_ntz").alias("trigger_time"),
        strategy.alias("strategy"), F.lit(True).alias("lock_rows"), F.lit(QUEUED).alias("status"),
        F.col("_tm_priority").cast("int").alias("priority"),
        F.when(F.col("events") > 1, F.col("latest_event_time")).alias("event_time_latest"),
    )
    return out.select(*QUEUE_COLUMNS)


def enqueue_from_feed(feed: DataFrame, attrs: DataFrame, catalog: str,
                      plan: DataFrame | None = None) -> DataFrame:
    """Feed -> one queue record per table (coalesce first, then join attributes)."""
    return enqueue_records(coalesce_feed(feed), attrs, catalog, plan)


def enqueue_all_tables(feed: DataFrame, catalog: str) -> DataFrame:
    """Feed -> one queue record per table without attributes: every table of the feed is loaded.

    The target is always ``catalog`` and the source name, the load is staged,
    the priority 1 and the primary key unknown (null).
    """
    out = coalesce_feed(feed).select(
        "source_table", F.concat(F.lit(f"{catalog}."), F.col("source_table")).alias("target_table"),
        F.lit("").alias("where_clause"), F.lit(None).cast("string").alias("primary_key"),
        F.col("first_event_time").alias("event_time"), F.lit(None).cast("timestamp_ntz").alias("trigger_time"),
        F.lit(STAGED).alias("strategy"), F.lit(True).alias("lock_rows"), F.lit(QUEUED).alias("status"),
        F.lit(1).alias("priority"),
        F.when(F.col("events") > 1, F.col("latest_event_time")).alias("event_time_latest"),
    )
    return out.select(*QUEUE_COLUMNS)
