"""Which rows differ between two tables, by digests of hash buckets.

Each side is first reduced to one digest per hash bucket of its keys, a coarse
and then a finer one; only rows of the buckets that differ are
brought together by key. Two equal tables cost one aggregation, and a few
damaged rows cost the rows that share their fine buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.loading import key_columns
from tidemark.sinks.tables import materialize

MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def _hash(columns: Sequence[Column]) -> Column:
    """A 64-bit hash in which a null counts by its place."""
    return F.xxhash64(*[x for c in columns for x in (c, c.isNull())])


def _digests(df: DataFrame, bucket: Column, row: Column, side: str) -> DataFrame:
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias(f"{side}_n"), F.sum(row.cast("decimal(38,0)")).alias(f"{side}_h"))


def _unequal(source: DataFrame, target: DataFrame, bucket: Column, row: Column) -> DataFrame:
    """The buckets whose digests differ."""
    both = _digests(source, bucket, row, "s").join(_digests(target, bucket, row, "t"), "bucket", "full_outer")
    same = F.col("s_n").eqNullSafe(F.col("t_n")) & F.col("s_h").eqNullSafe(F.col("t_h"))
    return both.where(~same).select("bucket")


def find_differences(source: DataFrame, target: DataFrame, primary_key: str | Sequence[str], *,
                     columns: Sequence[str] | None = None, coarse: int = 1024, fine: int = 256) -> DataFrame:
    """Keys that differ: the key columns, ``difference`` and ``changed_columns``.

    ``difference`` is ``missing`` (only in ``source``), ``extra`` (only in
    ``target``) or ``changed``; ``changed_columns`` names the columns whose
    values differ. The source is compared in the target's types. A key is equal to itself whether null or
    not, and of repeated keys the whole group is compared.

    At most ``coarse`` and ``coarse * fine`` bucket numbers are broadcast. Rows are
    hashed to 64 bits: a difference could hide behind equal sums of hashes, by
    chance once in 2 ** 64 buckets.
    """
    keys = key_columns(primary_key)
    kinds = {f.name: f.dataType for f in target.schema.fields}
    cols = [c for c in (columns or target.columns) if c not in keys]

    def side(df: DataFrame) -> DataFrame:
        typed = df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in [*keys, *cols]])
        return typed.withColumn("_tm_key", _hash([F.col(k) for k in keys])).withColumn(
            "_tm_row", _hash([F.col(c) for c in [*keys, *cols]]))

    s, t = side(source), side(target)
    top = F.pmod("_tm_key", F.lit(coarse))
    low = F.pmod("_tm_key", F.lit(coarse * fine))  # the rows of a fine bucket are in one coarse bucket
    first = materialize(_unequal(s, t, top, F.col("_tm_row")), "differences")
    s, t = (x.join(F.broadcast(first), top == F.col("bucket"), "left_semi") for x in (s, t))
    second = materialize(_unequal(s, t, low, F.col("_tm_row")), "differences")
    s, t = (x.join(F.broadcast(second), low == F.col("bucket"), "left_semi") for x in (s, t))

    def grouped(df: DataFrame, name: str) -> DataFrame:
        parts = [F.sum(_hash([F.col(c)]).cast("decimal(38,0)")).alias(f"{name}_{i}") for i, c in enumerate(cols)]
        return df.groupBy(*[F.col(k).alias(f"{name}_key_{k}") for k in keys]).agg(
            F.count(F.lit(1)).alias(f"{name}_n"), F.sum(F.col("_tm_row").cast("decimal(38,0)")).alias(f"{name}_h"), *parts)

    a, b = grouped(s, "s"), grouped(t, "t")
    on = reduce(lambda x, y: x & y, [F.col(f"s_key_{k}").eqNullSafe(F.col(f"t_key_{k}")) for k in keys])
    j = a.join(b, on, "full_outer")
    same = F.col("s_n").eqNullSafe(F.col("t_n")) & F.col("s_h").eqNullSafe(F.col("t_h"))
    kind = F.when(F.col("t_n").isNull(), MISSING).when(F.col("s_n").isNull(), EXTRA).otherwise(CHANGED)
    changed = F.when(kind == CHANGED, F.filter(
        F.array(*[F.when(~F.col(f"s_{i}").eqNullSafe(F.col(f"t_{i}")), F.lit(c)) for i, c in enumerate(cols)])
        if cols else F.array().cast("array<string>"), lambda c: c.isNotNull()))
    return j.where(~same).select(
        *[F.when(F.col("s_n").isNull(), F.col(f"t_key_{k}")).otherwise(F.col(f"s_key_{k}")).alias(k) for k in keys],
        kind.alias("difference"), changed.alias("changed_columns"))
