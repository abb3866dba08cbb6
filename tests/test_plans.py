"""Plan-shape checks: the properties that matter at scale stay true."""

import contextlib
import io

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import loading, planning, ranking
from tidemark.plans.fixtures import CYCLE_END, CYCLE_START, RANK_AS_OF, SLOTS, Fixtures
from tidemark.sources.feed import incremental_scan


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_feed_range_reaches_the_scan(spark):
    p = plan(incremental_scan(Fixtures(spark, SF_SMALL).feed, CYCLE_START, CYCLE_END))
    assert "GreaterThan(ts,2024-01-20T00:00)" in p and "LessThanOrEqual(ts,2024-01-21T00:00)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p


def test_claims_limit_rows_before_the_shuffle(spark):
    fx = Fixtures(spark, SF_SMALL)
    p = plan(ranking.claim_slots(ranking.priority_rank(fx.queue, fx.attrs, RANK_AS_OF), SLOTS), "simple")
    assert "WindowGroupLimit" in p


def test_claims_do_not_rank_the_whole_queue(spark):
    fx = Fixtures(spark, SF_SMALL)
    for df in (ranking.claim_eligible(fx.queue, fx.attrs, RANK_AS_OF, SLOTS),
               ranking.next_eligible(fx.queue, fx.attrs, RANK_AS_OF)):
        p = plan(df, "simple")
        assert "rangepartitioning" not in p and "Nested" not in p and "Cartesian" not in p


def test_cdc_plan_scans_each_side_once(spark):
    fx = Fixtures(spark, SF_SMALL)
    p = plan(planning.cdc_plan(fx.load_source, fx.load_target, "o_orderpriority", "o_orderdate"), "simple")
    assert p.count("FileScan parquet") == 2
    assert "partial_max" in p and "partial_count" in p


def test_merge_scans_target_once_and_shuffles_keys_only(spark):
    fx = Fixtures(spark, SF_SMALL)
    p = plan(loading.merge_pk(fx.load_target, fx.load_source, "o_orderkey"), "simple")
    assert p.count("FileScan parquet") == 3  # target once; payload keys and payload rows
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_replace_where_predicate_is_pushed(spark):
    fx = Fixtures(spark, SF_SMALL)
    p = plan(loading.replace_where(fx.load_target, fx.load_source, "o_orderdate >= '1998-01-01'"))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in p


def test_global_rank_broadcasts_only_partition_offsets(spark):
    df = spark.range(1000).select((F.col("id") % 13).alias("p"), F.col("id").alias("k"))
    p = plan(ranking.global_row_number(df, [F.col("p").desc(), F.col("k")], num_partitions=4), "simple")
    assert "BroadcastHashJoin" in p and "rangepartitioning" not in p  # placement already materialized


def test_merge_into_bucketed_target_does_not_shuffle_the_target(spark):
    from tidemark.sinks import tables
    tgt = spark.range(2000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    tables.publish_bucketed(tgt, "tm_bucketed_target", ["id"], 8)
    payload = spark.range(1990, 2010).select(F.col("id"), F.lit(99).cast("bigint").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join a large payload gets
    try:
        merged = loading.merge_pk(spark.table("tm_bucketed_target"), payload, "id")
        p = plan(merged, "simple")
        got = {r.id: r.v for r in merged.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and p.count("Exchange hashpartitioning") == 1  # payload keys only
    assert len(got) == 2010 and got[1995] == 99 and got[5] == 5
