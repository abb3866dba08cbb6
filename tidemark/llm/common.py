"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sinks.tables import materialize

BATCH_BYTES = 2 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand rows to Python in Arrow batches of about ``BATCH_BYTES``, a larger row alone.

    By default 10,000 rows make a batch, of up to 64 MB: for texts that is a whole
    partition, which then lies in the JVM's buffers (twice), in the worker's and in
    its lists at once, for every core. A smaller limit of the session's own stays. What a
    DataFrame holds does not change; one that is run later has the session's limit.
    """
    before = spark.conf.get(BATCH_LIMIT)
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    if not 0 < own <= BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_LIMIT, before)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less every column whose name equals one of ``names``, whatever its case.

    Operators that add columns call this first, so an input column of the same
    name is replaced and never makes a reference ambiguous.
    """
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in low])


def running_totals(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df``, dealt evenly and written once, with ``out``: the sum of ``value`` over the rows before, in the order written.

    Totals per partition, one row each, give every partition its offset; rows
    are only summed within their partition. Columns ``__at`` and ``__part`` must not be in ``df``.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = materialize(df.repartition(parts).withColumn("__at", F.monotonically_increasing_id()), "totals").withColumn(
        "__part", F.shiftright("__at", 33))  # the partition is above the place of a row in it
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    heads = (table.groupBy("__part").agg(F.sum(value).alias("__sum"))
             .select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__head")))
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    return (table.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(F.broadcast(heads), "__part")  # one row per partition
            .withColumn(out, (F.col(out) + F.col("__head")).cast("long")).drop("__at", "__part", "__head"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: ``(node, component)``.

    ``edges`` has long columns ``a`` and ``b`` (self loops, repeats and either
    direction are fine; a null end is ignored). ``component`` is the smallest
    node reachable. Nodes without an edge to another node do not appear.

    Alternating large-star and small-star rounds. Each round is written to the
    shared folder, so a lost executor re-reads files; the driver only sees a
    count and a checksum. A hub's rows meet one minimum per node in a plain
    join, which adaptive execution may split; minima are combined before the
    shuffle.
    """
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = materialize(e, "components")
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if not mark["n"] or mark == seen:
            break
        seen = mark
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "components")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
