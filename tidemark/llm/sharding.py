"""Sharding by byte-size prefix sums (DataFrame functions only).

Rows are put in one global order by a range shuffle and written once, with
their place in their partition. Per-partition totals (one row per partition)
give every partition its byte and row offset. A shard boundary at an equal
byte target falls inside one partition, so running sums are only needed in the
few partitions that a boundary crosses; all other partitions lie whole in one
shard. No row-level window ever covers more than one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import without
from tidemark.sinks.tables import materialize

HELPERS = ["__tie", "__at", "__size", "__part", "__place", "__row0", "__cuts", "__first"]
ROW_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below


def text_size(text: Column) -> Column:
    """Bytes of a text in UTF-8 (null: none) plus one for its separator."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def byte_shards(df: DataFrame, n_shards: int, *, order_by: list[str], size: Column,
                partitions: int | None = None) -> DataFrame:
    """Contiguous shards of near-equal bytes: the rows of ``df`` plus ``size``, ``shard``, ``slot``.

    Rows are ordered by ``order_by`` (nulls first); rows equal in all of it
    follow in input order, so one key may hold any part of the table. A row
    goes to the shard in which the middle of its byte interval lies, so each
    boundary is off by at most half a row. ``slot`` counts from 0 in each
    shard, in that order. ``partitions`` (default: the session's shuffle
    partitions) is the number of range partitions.

    Empty table: no rows. Input columns named like the three added ones, or
    like a name of ``HELPERS``, are replaced or dropped. ``size`` must not be null or negative; sizes of zero are allowed
    as long as the total is not zero (else all rows go to shard 0).
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order_by] + [F.col("__tie").asc()]
    clear = [h for h in HELPERS if h != "__size"]
    sized = without(without(df, ["__size"]).withColumn("__size", size), ["size", "shard", "slot", *clear])
    table = materialize(
        sized.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys).drop("__tie").withColumn("__at", F.monotonically_increasing_id()), "sharding")

    part = F.shiftright("__at", ROW_BITS).alias("part")
    place = F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("place")
    thin = table.select(part, place, F.col("__size").alias("bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    heads = (thin.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
             .select("part", "bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
                     F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row0"),
                     F.sum("bytes").over(Window.partitionBy()).alias("total")))

    def shard_of(twice_middle: str) -> Column:  # 38 digits: sizes times shards may pass 64 bits
        return F.expr(f"cast(coalesce(least({n_shards - 1}, (cast({twice_middle} as decimal(30,0)) * {n_shards}) "
                      "div (2 * cast(total as decimal(30,0)))), 0) as int)")

    total = F.expr("nullif(total, 0)")
    heads = materialize(heads.withColumn("total", total)
                        .withColumn("first", shard_of("2 * byte0"))
                        .withColumn("last", shard_of("2 * (byte0 + bytes) - 1")), "sharding")
    crossed = heads.where("first < last").select("part", "byte0", "total")  # fewer than n_shards rows
    running = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (thin.join(F.broadcast(crossed), "part")
            .withColumn("end", F.col("byte0") + F.sum("bytes").over(running))
            .withColumn("shard", shard_of("2 * end - bytes"))
            .groupBy("part", "shard").agg(F.min("place").alias("place"))
            .groupBy("part").agg(F.sort_array(F.collect_list(F.struct("place", "shard"))).alias("cuts")))
    plan = materialize(heads.join(cuts, "part", "left").withColumn(
        "cuts", F.expr("coalesce(cuts, array(struct(cast(0 as bigint) as place, first as shard)))"))
        .select("part", "row0", "cuts"), "sharding")
    firsts = (plan.select("row0", F.explode("cuts").alias("cut"))
              .groupBy(F.col("cut.shard").alias("shard")).agg(F.min(F.expr("row0 + cut.place")).alias("__first")))
    # plan: one row per range partition; firsts: one row per shard
    return (table.withColumn("__part", F.shiftright("__at", ROW_BITS))
            .withColumn("__place", F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
            .join(F.broadcast(plan.select(F.col("part").alias("__part"), F.col("row0").alias("__row0"),
                                          F.col("cuts").alias("__cuts"))), "__part")
            .withColumn("shard", F.expr("array_max(transform(filter(__cuts, c -> c.place <= __place), c -> c.shard))"))
            .join(F.broadcast(firsts), "shard")
            .withColumn("slot", F.col("__row0") + F.col("__place") - F.col("__first"))
            .withColumn("size", F.col("__size"))
            .select(*[c for c in table.columns if c not in ("__at", "__size")], "size", "shard", "slot"))
