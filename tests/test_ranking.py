"""Staleness tiers, global ranking and claims: edge rows and brute-force checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.staleness import staleness_minutes, staleness_tier
from tidemark.functions.timeexpr import ntz
from tidemark.operators import ranking
from tidemark.schemas import ATTRS, QUEUE

AS_OF = "2024-01-20 12:00:00"


def tier(spark, st, lo, hi):
    df = spark.createDataFrame([(st, lo, hi)], "st bigint, lo int, hi int")
    return df.select(staleness_tier(F.col("st"), F.col("lo"), F.col("hi")).alias("t")).first()["t"]


@pytest.mark.parametrize("slack,weight", [
    (61, 1), (60, 2), (46, 2), (45, 3), (31, 3), (30, 4), (16, 4), (15, 5), (11, 5), (10, 6), (6, 6), (5, 7),
    (4, 7), (3, 8), (2, 9), (1, 10), (0, 15), (-4, 15), (-5, 20), (-9, 20), (-10, 25), (-500, 25)])
def test_tier_boundaries(spark, slack, weight):
    assert tier(spark, 100, 0, 100 + slack) == weight


def test_tier_nulls_and_hidden(spark):
    assert tier(spark, 10, 30, 1000) == 0          # fresher than min staleness: hidden
    assert tier(spark, 10, None, 1000) == 1        # null min never hides
    assert tier(spark, 10, 0, None) == 25          # null max falls to the floor weight
    assert tier(spark, -5, 0, 100) == 0            # event after as_of: negative staleness < 0


def test_staleness_floor_on_whole_seconds(spark):
    df = spark.range(1).select(
        staleness_minutes(ntz("2024-01-20 11:58:59.900"), ntz("2024-01-20 12:00:00.100")).alias("a"),
        staleness_minutes(ntz("2024-01-20 12:00:30"), ntz("2024-01-20 12:00:00")).alias("b"))
    r = df.first()
    assert r["a"] == 1 and r["b"] == -1


def _queue(spark, rows):
    full = [(s, "T." + s, "", None, ntz_val, None, strat, True, st, p, None) for s, ntz_val, strat, st, p in rows]
    return spark.createDataFrame(full, QUEUE)


def _attrs(spark, names, lo=0, hi=10_000):
    return spark.createDataFrame([(n, None, "snapshot", None, None, "JDBC", False, 1, lo, hi) for n in names], ATTRS)


def test_priority_rank_ties_and_filters(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 20, 10, 0, 0)
    rows = [("S.B", t, "JDBC", "Q", 2), ("S.A", t, "JDBC", "Q", 2), ("S.C", t - dt.timedelta(minutes=5), "JDBC", "Q", 2),
            ("S.D", t, "WriteNOS", "R", 9), ("S.E", t, "TPT", "Q", 1), ("S.F", t, "JDBC", "Q", 0)]
    q = _queue(spark, rows)
    a = _attrs(spark, ["S.A", "S.B", "S.C", "S.D", "S.E", "S.F"])
    got = [(r.source_table, r.rank) for r in ranking.priority_rank(q, a, AS_OF).orderBy("rank").collect()]
    # running and zero-priority rows are not eligible; equal priority -> older first -> name
    assert got == [("S.C", 1), ("S.A", 2), ("S.B", 3), ("S.E", 4)]


def test_priority_rank_empty_and_all_hidden(spark):
    import datetime as dt
    q = _queue(spark, [("S.A", dt.datetime(2024, 1, 20, 11, 59), "JDBC", "Q", 1)])
    a = _attrs(spark, ["S.A"], lo=90)
    assert ranking.priority_rank(q, a, AS_OF).count() == 0
    empty = spark.createDataFrame([], QUEUE)
    assert ranking.priority_rank(empty, a, AS_OF).count() == 0


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 20), rnd.randint(0, 1000), f"k{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(data, "p int, t int, k string")
    order = [F.col("p").desc(), F.col("t").asc(), F.col("k").asc()]
    got = {r.k: r.rank for r in ranking.global_row_number(df, order, num_partitions=7).collect()}
    want = {k: i + 1 for i, (p, t, k) in enumerate(sorted(data, key=lambda x: (-x[0], x[1], x[2])))}
    assert got == want


def _ranked(spark, strategies):
    rows = [(f"S.T{i}", f"T.T{i}", "", "", None, s, True, 1, i + 1) for i, s in enumerate(strategies)]
    return spark.createDataFrame(rows, "source_table string, target_table string, where_clause string, "
                                       "primary_key string, event_time timestamp_ntz, strategy string, "
                                       "lock_rows boolean, priority int, rank bigint")


def test_claim_slots_spill_over(spark):
    # 2 staged rows for 3 staged slots: one idle staged worker takes the next direct row
    r = _ranked(spark, ["JDBC", "WriteNOS", "JDBC", "TPT", "JDBC", "WriteNOS", "JDBC"])
    got = {(x.source_table, x.worker) for x in ranking.claim_slots(r, {"JDBC": 2, "WriteNOS": 3}).collect()}
    assert got == {("S.T0", "JDBC"), ("S.T2", "JDBC"), ("S.T4", "WriteNOS"),
                   ("S.T1", "WriteNOS"), ("S.T5", "WriteNOS")}


def test_claim_slots_no_spill_and_tpt_never(spark):
    r = _ranked(spark, ["TPT", "WriteNOS", "WriteNOS", "JDBC", "JDBC"])
    got = {(x.source_table, x.worker) for x in ranking.claim_slots(r, {"JDBC": 1, "WriteNOS": 1}).collect()}
    assert got == {("S.T1", "WriteNOS"), ("S.T3", "JDBC")}


def test_claim_next_per_strategy(spark):
    r = _ranked(spark, ["TPT", "WriteNOS", "WriteNOS", "JDBC"])
    got = {(x.strategy, x.source_table) for x in ranking.claim_next(r).collect()}
    assert got == {("TPT", "S.T0"), ("WriteNOS", "S.T1"), ("JDBC", "S.T3")}
    assert [x.source_table for x in ranking.claim_next(r, "WriteNOS").collect()] == ["S.T1"]


def test_rank_contract(spark):
    q = spark.createDataFrame([], QUEUE)
    with pytest.raises(ValueError):
        ranking.rank_queue(q, _attrs(spark, []), AS_OF, view=lambda q, a, t: q)
    assert "rank" in ranking.rank_queue(q, _attrs(spark, []), AS_OF, view=ranking.fifo_rank).columns


def test_global_row_number_with_aqe_coalesced_ranges(spark):
    """AQE merges neighbouring range partitions; numbering must stay exact."""
    rnd = random.Random(11)
    data = [(rnd.randint(0, 5), rnd.randint(0, 50), f"k{i:05d}") for i in range(20000)]
    df = spark.createDataFrame(data, "p int, t int, k string").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        ranked = ranking.global_row_number(df, [F.col("p").desc(), F.col("t"), F.col("k")])
        got = {r.k: r.rank for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    want = {k: i + 1 for i, (p, t, k) in enumerate(sorted(data, key=lambda x: (-x[0], x[1], x[2])))}
    assert got == want


def test_claims_without_the_whole_rank_equal_those_of_the_rank(spark):
    rng = random.Random(5)
    names = [f"S.T{i}" for i in range(60)]
    queue = [(n, f"T.{n}", "", "", dt.datetime(2024, 1, 20, rng.randrange(12), 0), None, rng.choice(["JDBC", "WriteNOS", "TPT"]),
              True, rng.choice("QQQR"), rng.randrange(3), None) for n in names]
    attrs = [(n, None, "cdc", "u", "id", "JDBC", False, 1, rng.choice([0, 300]), rng.choice([60, 720, 900]))
             for n in names[:50]]
    q, a = spark.createDataFrame(queue, QUEUE), spark.createDataFrame(attrs, ATTRS)
    ranked = ranking.priority_rank(q, a, AS_OF)
    for slots in ({"JDBC": 3, "WriteNOS": 20}, {"JDBC": 1, "WriteNOS": 1}, {}):
        want = sorted(ranking.claim_slots(ranked, slots).collect())
        assert sorted(ranking.claim_eligible(q, a, AS_OF, slots).collect()) == want
    assert sorted(ranking.next_eligible(q, a, AS_OF).collect()) == sorted(ranking.claim_next(ranked).collect())
    none = spark.createDataFrame([], QUEUE)
    assert ranking.claim_eligible(none, a, AS_OF, {"JDBC": 1}).count() == 0
    assert ranking.next_eligible(none, a, AS_OF).count() == 0
