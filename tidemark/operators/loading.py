"""Table loads as DataFrame rewrites: overwrite, replace-where, primary-key merge.

Plain Parquet tables have no row-level MERGE / DELETE, so each load computes
the next version of the target; a sink publishes it (new folder, or dynamic
partition overwrite of the touched partitions).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.projection import typed_projection

# Fixed value: a replication bookkeeping column that payloads never carry.
REPLICATION_COLUMN = "REPLICATE_IO_METADATA_VERSION"


def payload_schema(target: DataFrame) -> T.StructType:
    """The target's columns a payload must provide (the replication column excluded)."""
    return T.StructType([f for f in target.schema.fields if f.name != REPLICATION_COLUMN])


def key_columns(primary_key: str | Sequence[str]) -> list[str]:
    """'a, b' -> ['a', 'b']."""
    keys = primary_key.split(",") if isinstance(primary_key, str) else list(primary_key)
    keys = [k.strip() for k in keys if k and k.strip()]
    if not keys:
        raise ValueError("empty primary key")
    return keys


def predicate(where: str | Column) -> Column:
    return F.expr(where) if isinstance(where, str) else where


def overwrite(source: DataFrame, target_schema: T.StructType) -> DataFrame:
    """The whole payload, cast to the target schema, becomes the table."""
    return typed_projection(source, target_schema)


def truncate_append(source: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Empty the target, then bulk-append the payload: the same rows as ``overwrite``."""
    return overwrite(source, target_schema)


def replace_where(target: DataFrame, source: DataFrame, where: str | Column) -> DataFrame:
    """Delete target rows matching the predicate, then append the matching payload rows.

    ``DELETE WHERE p`` keeps rows where ``p`` is null, hence ``coalesce(p, false)``.
    Running it twice gives the same table (idempotent incremental load).
    """
    p = predicate(where)
    kept = target.where(~F.coalesce(p, F.lit(False)))
    fresh = typed_projection(source.where(p), payload_schema(target))
    return kept.unionByName(fresh, allowMissingColumns=True)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def merge_pk(target: DataFrame, source: DataFrame, primary_key: str | Sequence[str]) -> DataFrame:
    """MERGE on a (composite) primary key: update every matched row, insert the rest.

    Written as target-anti-payload-keys plus payload: one scan of the target,
    and only the payload's key columns are shuffled (or broadcast when the
    planner measures them small). SQL ``=`` never matches a null key, so
    null-key target rows are kept and null-key payload rows inserted; null keys
    are dropped from the key side, and a target partition crowded with null
    keys is split by AQE's skew-join handling of the anti join's left side.
    Columns of the target that the payload does not carry keep their value in
    matched rows (the payload's keys are joined with them then) and are null in
    inserted ones. Duplicate payload keys are the caller's to reject
    (``duplicate_keys``).
    """
    keys = key_columns(primary_key)
    payload = typed_projection(source, payload_schema(target))
    s_keys = payload.where(~_any_null(keys)).select(*keys)
    extra = [c for c in target.columns if c not in payload.columns]
    if extra:  # a key that the target holds more than once gives one row, the last in order of the kept columns
        kept = target.where(~_any_null(keys)).groupBy(*keys).agg(F.max(F.struct(*extra)).alias("_tm_kept"))
        payload = payload.join(kept, keys, "left").select(*payload.columns, *[F.col(f"_tm_kept.{c}").alias(c) for c in extra])
    return target.join(s_keys, keys, "left_anti").unionByName(payload, allowMissingColumns=True)


def duplicate_keys(source: DataFrame, primary_key: str | Sequence[str]) -> DataFrame:
    """Payload keys that occur more than once (lazy; partial aggregation per task)."""
    keys = key_columns(primary_key)
    return (source.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


# Pluggable load strategies: name -> (target, payload, plan) -> next target.
LoadFn = Callable[[DataFrame, DataFrame, dict], DataFrame]

STRATEGIES: dict[str, LoadFn] = {
    "overwrite": lambda target, payload, plan: overwrite(payload, target.schema),
    "truncate_append": lambda target, payload, plan: truncate_append(payload, target.schema),
    "replace_where": lambda target, payload, plan: replace_where(target, payload, plan["where_clause"]),
    "merge": lambda target, payload, plan: merge_pk(target, payload, plan["primary_key"]),
}


def apply_load(mode: str, target: DataFrame, payload: DataFrame, plan: dict) -> DataFrame:
    """Run a named load strategy; unknown names are an error."""
    try:
        fn = STRATEGIES[mode]
    except KeyError:
        raise NotImplementedError(f"load strategy {mode!r} is not implemented") from None
    return fn(target, payload, plan)
