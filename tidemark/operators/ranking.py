"""Priority ranking, FIFO ranking and claims of the next rows to load.

A global ``ROW_NUMBER() OVER (ORDER BY ...)`` would move every row into one
task. ``global_row_number`` instead range-partitions on the order keys, numbers
rows inside each range partition and adds the row count of all earlier
partitions; only the per-partition counts (one row per partition) are brought
together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.staleness import next_step, staleness_minutes, staleness_tier, weighted_priority
from tidemark.functions.timeexpr import ntz
from tidemark.schemas import DIRECT, QUEUED, STAGED
from tidemark.sinks.tables import materialize

RANK_COLUMNS = [
    "source_table", "target_table", "where_clause", "primary_key", "event_time",
    "strategy", "lock_rows", "priority",
]


def priority_order() -> list[Column]:
    return [F.col("priority").desc(), F.col("event_time").asc(), F.col("source_table").asc()]


def fifo_order() -> list[Column]:
    return [F.col("event_time").asc(), F.col("source_table").asc()]


def _as_instant(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else ntz(as_of)


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number over a total order, computed without a single task.

    Rows are range-partitioned on the order keys and sorted inside each
    partition; (partition id, position in partition) are then written once
    to the shared work folder (a lineage cut like a reliable checkpoint).
    Counting per partition and numbering both read that data, so they agree
    even when a re-run would sample different range bounds or fetch shuffle
    blocks in another order. Only one count row per partition is combined and
    broadcast.
    """
    # Without a fixed count AQE sizes the range partitions from the data; it only
    # merges neighbouring ranges (never splits one), so order is kept.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_tm_part", F.spark_partition_id())
        .withColumn("_tm_pos", F.monotonically_increasing_id()
                    - F.shiftleft(F.col("_tm_part").cast("bigint"), 33))
    )
    placed = materialize(placed, "rank")
    counts = placed.groupBy("_tm_part").agg(F.count(F.lit(1)).alias("_tm_n"))
    before = Window.orderBy("_tm_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tm_part", F.coalesce(F.sum("_tm_n").over(before), F.lit(0)).alias("_tm_off"))
    # offsets holds one row per range partition: a proven bound for broadcast.
    out = placed.join(F.broadcast(offsets), "_tm_part")
    return out.withColumn(name, (F.col("_tm_off") + F.col("_tm_pos") + 1).cast("bigint")).drop(
        "_tm_part", "_tm_pos", "_tm_off")


def with_staleness(queue: DataFrame, attrs: DataFrame, as_of) -> DataFrame:
    """Queue rows joined to their attributes with staleness minutes and tier.

    Inner join: queued tables without attributes drop out; ``disabled`` is not
    looked at here (the reference view does not either).
    """
    d = attrs.select("source_table", "min_staleness", "max_staleness")
    j = queue.join(d, "source_table")
    st = staleness_minutes(F.col("event_time"), _as_instant(as_of))
    return (j.withColumn("staleness_m", st)
             .withColumn("tier", staleness_tier(F.col("staleness_m"), F.col("min_staleness"),
                                                F.col("max_staleness"))))


def staleness_tiers(queue: DataFrame, attrs: DataFrame, as_of) -> DataFrame:
    """Histogram of tiers over queued rows: tier, rows (bigint)."""
    s = with_staleness(queue.where(F.col("status") == QUEUED), attrs, as_of)
    return s.groupBy("tier").agg(F.count(F.lit(1)).alias("rows"))


def eligible(queue: DataFrame, attrs: DataFrame, as_of) -> DataFrame:
    """Queued rows with their weighted priority, where that is over 0 (``RANK_COLUMNS``)."""
    s = with_staleness(queue.where(F.col("status") == QUEUED), attrs, as_of)
    weighted = s.select(*[c for c in RANK_COLUMNS if c != "priority"],
                        weighted_priority(F.col("tier"), F.col("priority")).alias("priority"))
    return weighted.where(F.col("priority") > 0)


def priority_rank(queue: DataFrame, attrs: DataFrame, as_of) -> DataFrame:
    """Eligible queued rows with weighted priority and global rank.

    Eligible: status 'Q' and weighted priority > 0. Rank order: weighted
    priority desc, event_time asc, source_table asc.
    """
    return global_row_number(eligible(queue, attrs, as_of), priority_order()).select(*RANK_COLUMNS, "rank")


def fifo_rank(queue: DataFrame, attrs: DataFrame | None = None, as_of=None) -> DataFrame:
    """Queued rows in arrival order, priority forced to 1 (source_table breaks ties)."""
    q = queue.where(F.col("status") == QUEUED).select(
        *[c for c in RANK_COLUMNS if c != "priority"], F.lit(1).alias("priority"))
    return global_row_number(q, fifo_order()).select(*RANK_COLUMNS, "rank")


RankView = Callable[[DataFrame, DataFrame, object], DataFrame]


def check_rank_contract(ranked: DataFrame) -> DataFrame:
    """A user ranking must expose the queue columns and a ``rank`` column."""
    missing = [c for c in [*RANK_COLUMNS, "rank"] if c not in ranked.columns]
    if missing:
        raise ValueError(f"ranking view lacks column(s): {missing}")
    return ranked


def rank_queue(queue: DataFrame, attrs: DataFrame, as_of, view: RankView = priority_rank) -> DataFrame:
    """Apply a (user-replaceable) ranking and check its contract."""
    return check_rank_contract(view(queue, attrs, as_of))


def claim_next(ranked: DataFrame, strategy: str | None = None) -> DataFrame:
    """The lowest-rank row per strategy (one row each), via a partial aggregate."""
    r = ranked if strategy is None else ranked.where(F.col("strategy") == strategy)
    r = r.where(F.col("rank") >= 1)
    payload = [c for c in [*RANK_COLUMNS, "rank"] if c != "strategy"]
    best = r.groupBy("strategy").agg(F.min_by(F.struct(*payload), F.col("rank")).alias("_tm_best"))
    return best.select(*[F.col(f"_tm_best.{c}").alias(c) if c != "strategy" else F.col("strategy")
                         for c in [*RANK_COLUMNS, "rank"]])


def claim_slots(ranked: DataFrame, slots: Mapping[str, int]) -> DataFrame:
    """Assign the best rows to free worker slots, per strategy, with spill-over.

    Direct (JDBC) workers take the best direct rows first; staged (WriteNOS)
    workers take staged rows, and staged workers left idle take the next
    direct rows. Other strategies are never claimed. The output adds
    ``worker`` (the pool that takes the row) and is bounded by the slot count.
    """
    return _assign(ranked, slots, [F.col("rank").asc()]).select(*RANK_COLUMNS, "rank", "worker")


def _assign(rows: DataFrame, slots: Mapping[str, int], order: Sequence[Column]) -> DataFrame:
    """The best rows per strategy in ``order``, with the ``worker`` that takes each."""
    j = int(slots.get(DIRECT, 0))
    w = int(slots.get(STAGED, 0))
    limit = max(j + w, w, 1)
    per = Window.partitionBy("strategy").orderBy(*order)
    top = (rows.where(F.col("strategy").isin(DIRECT, STAGED))
           .withColumn("_tm_rn", F.row_number().over(per))
           .where(F.col("_tm_rn") <= limit))  # WindowGroupLimit: at most `limit` rows per strategy leave a task
    # At most 2 * limit rows remain, so a global window over them is bounded by the slot counts.
    everyone = Window.partitionBy()
    staged_used = F.count(F.when((F.col("strategy") == STAGED) & (F.col("_tm_rn") <= w), 1)).over(everyone)
    spare = F.lit(w) - staged_used
    worker = (F.when((F.col("strategy") == STAGED) & (F.col("_tm_rn") <= w), F.lit(STAGED))
               .when((F.col("strategy") == DIRECT) & (F.col("_tm_rn") <= j), F.lit(DIRECT))
               .when((F.col("strategy") == DIRECT) & (F.col("_tm_rn") <= F.lit(j) + spare), F.lit(STAGED)))
    return top.withColumn("worker", worker).where(F.col("worker").isNotNull()).drop("_tm_rn")


def with_priority_rank(few: DataFrame, rows: DataFrame) -> DataFrame:
    """``few`` of the eligible ``rows`` with the rank that ``priority_rank`` gives them.

    ``few`` must be small (claims, one row per strategy) and stable between
    reads (written once). Their order keys form one sorted array; one aggregate
    over ``rows`` counts the rows between neighbouring keys, and a rank is the
    count of rows ahead. No row of the queue is sorted or shuffled for it.
    """
    key = F.struct((-F.col("priority")).alias("p"), F.col("event_time").alias("t"), F.col("source_table").alias("s"))
    keys = few.agg(F.sort_array(F.collect_list(key))).scalar()  # a column of its own: no subqueries in lambdas
    between = (rows.withColumn("_tm_keys", keys)
               .select(F.size(F.filter("_tm_keys", lambda k: k <= key)).alias("b"))
               .groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    counts = between.agg(F.collect_list(F.struct("b", "n"))).scalar()  # at most one entry more than there are keys
    same = Window.partitionBy("priority", "event_time", "source_table").orderBy("strategy")
    before = (few.withColumn("_tm_keys", keys).withColumn("_tm_counts", counts)
              .withColumn("_tm_before", F.size(F.filter("_tm_keys", lambda k: k < key)))
              .withColumn("_tm_at", F.row_number().over(same)))
    ahead = F.aggregate(F.filter("_tm_counts", lambda x: x["b"] <= F.col("_tm_before")), F.lit(0).cast("bigint"),
                        lambda acc, x: acc + x["n"])
    return before.withColumn("rank", ahead + F.col("_tm_at")).drop("_tm_keys", "_tm_counts", "_tm_before", "_tm_at")


def claim_eligible(queue: DataFrame, attrs: DataFrame, as_of, slots: Mapping[str, int]) -> DataFrame:
    """``claim_slots`` of the priority ranking without ranking the whole queue.

    The best rows per strategy come straight from the eligible rows and are
    written once (at most as many as there are slots); only they get a rank.
    """
    rows = eligible(queue, attrs, as_of)
    taken = materialize(_assign(rows, slots, priority_order()), "claims")
    return with_priority_rank(taken, rows).select(*RANK_COLUMNS, "rank", "worker")


def next_eligible(queue: DataFrame, attrs: DataFrame, as_of) -> DataFrame:
    """``claim_next`` of the priority ranking (one row per strategy) without ranking the whole queue."""
    rows = eligible(queue, attrs, as_of)
    best = rows.groupBy("strategy").agg(F.min_by(
        F.struct(*[c for c in RANK_COLUMNS if c != "strategy"]),
        F.struct(-F.col("priority"), "event_time", "source_table")).alias("_tm_best"))
    few = materialize(best.select("strategy", "_tm_best.*"), "claims")
    return with_priority_rank(few, rows).select(*RANK_COLUMNS, "rank")


def changed_priorities(queue: DataFrame, attrs: DataFrame, start, end) -> DataFrame:
    """Queued rows whose weighted priority differs between two instants: ``source_table, event_time, before, after``.

    ``before`` and ``after`` are null where the row is not eligible. A row's tier
    is a step function of whole minutes of staleness, so the first minute at
    which it leaves its step after ``start`` is known from the row alone; only rows whose
    step ends by ``end`` are weighed again. Rows that come back to the same weight in between do not count.
    """
    s = with_staleness(queue.where(F.col("status") == QUEUED), attrs, start)
    end_m = staleness_minutes(F.col("event_time"), _as_instant(end))
    moved = s.withColumn("_tm_end", end_m).where(
        next_step(F.col("staleness_m"), F.col("min_staleness"), F.col("max_staleness")) <= F.col("_tm_end"))
    later = staleness_tier(F.col("_tm_end"), F.col("min_staleness"), F.col("max_staleness"))
    weights = moved.select("source_table", "event_time", weighted_priority(F.col("tier"), F.col("priority")).alias("b"),
                           weighted_priority(later, F.col("priority")).alias("a"))
    return weights.select("source_table", "event_time", F.when(F.col("b") > 0, F.col("b")).alias("before"),
                          F.when(F.col("a") > 0, F.col("a")).alias("after")).where(~F.col("before").eqNullSafe(F.col("after")))
