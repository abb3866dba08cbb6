"""Load rewrites, projections, planning and reconciliation on edge rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import loading, planning, projection
from tidemark.operators.projection import ColumnSpec
from tidemark.operators.reconcile import content_reconcile, count_reconcile, load_report, table_checksum
from tidemark.sinks import tables
from tidemark.sources.jdbc import jdbc_options

SCHEMA = "id bigint, k2 string, v double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x if x is not None else 0)
                                                                       for x in t))


def test_merge_null_keys_both_sides(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (None, "a", 3.0)], SCHEMA)
    src = spark.createDataFrame([(2, "a", 20.0), (4, "a", 40.0), (None, "a", 30.0)], SCHEMA)
    assert rows(loading.merge_pk(tgt, src, "id")) == [(1, "a", 1.0), (2, "a", 20.0), (4, "a", 40.0),
                                                      (None, "a", 3.0), (None, "a", 30.0)]


def test_merge_composite_and_all_key_table(spark):
    tgt = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], SCHEMA)
    src = spark.createDataFrame([(1, "y", 9.0), (2, "y", 3.0)], SCHEMA)
    assert rows(loading.merge_pk(tgt, src, "id, k2")) == [(1, "x", 1.0), (1, "y", 9.0), (2, "y", 3.0)]
    all_key = rows(loading.merge_pk(tgt.select("id", "k2"), src.select("id", "k2"), ["id", "k2"]))
    assert all_key == [(1, "x"), (1, "y"), (2, "y")]


def test_duplicate_keys(spark):
    src = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (None, "a", 1.0), (None, "b", 1.0)],
                                SCHEMA)
    assert [r.id for r in loading.duplicate_keys(src, "id").collect()] == [1]


def test_replace_where_null_predicate_and_idempotence(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)], SCHEMA)
    src = spark.createDataFrame([(2, "b", 20.0), (4, "b", 40.0), (5, "c", 50.0)], SCHEMA)
    once = loading.replace_where(tgt, src, "k2 = 'b'")
    assert rows(once) == [(1, "a", 1.0), (2, "b", 20.0), (3, None, 3.0), (4, "b", 40.0)]
    assert rows(loading.replace_where(once, src, "k2 = 'b'")) == rows(once)


def test_apply_load_dispatch(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    src = spark.createDataFrame([(2, "a", 2.0)], SCHEMA)
    assert rows(loading.apply_load("overwrite", tgt, src, {})) == [(2, "a", 2.0)]
    with pytest.raises(NotImplementedError):
        loading.apply_load("TPT", tgt, src, {})


def test_typed_projection_case_and_missing(spark):
    df = spark.createDataFrame([("1", "2024-01-02")], "ID string, D string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType())])
    assert projection.typed_projection(df, schema).first() == (1, dt.date(2024, 1, 2))
    with pytest.raises(ValueError, match="missing"):
        projection.typed_projection(df.drop("D"), schema)


def test_split_rejects(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "id string")
    good, bad = projection.split_rejects(df, T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(good.collect(), key=str) == sorted([(1,), (None,)], key=str) and bad.count() == 1


def test_source_text_projection_rules(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5), "abcdef", 12.345, 7, dt.datetime(2024, 1, 2, 13, 0), 99.5)],
        "ts timestamp_ntz, c string, n double, i int, d timestamp_ntz, u double")
    dic = [ColumnSpec("ts", "TS", max_length=16), ColumnSpec("c", "CF", format="X(3)"),
           ColumnSpec("n", "D", digits=5, fraction=2), ColumnSpec("i", "I"), ColumnSpec("d", "DA"),
           ColumnSpec("u", "N", digits=-128, fraction=-128)]
    target = T.StructType([T.StructField("u", T.StringType())])
    r = projection.source_text_projection(df, dic, target).first()
    assert r.ts == "2024-01-02 03:04" and r.c == "abc" and r.n == Decimal("12.35") and r.i == 7
    assert r.d == "2024-01-02" and r.u == "99.5"


def test_schema_from_dictionary_and_staging():
    dic = [ColumnSpec("a", "CV"), ColumnSpec("b", "DA"), ColumnSpec("c", "TS"), ColumnSpec("d", "I8"),
           ColumnSpec("e", "D", digits=10, fraction=2), ColumnSpec("f", "N", digits=-1, fraction=-1),
           ColumnSpec("g", "F"), ColumnSpec("h", "I2")]
    s = projection.target_schema_from_dictionary(dic)
    assert [f.dataType.simpleString() for f in s.fields] == [
        "string", "date", "timestamp_ntz", "bigint", "decimal(10,2)", "string", "double", "int"]
    staged = projection.staging_schema(s)
    assert [f.dataType.simpleString() for f in staged.fields][:3] == ["string", "string", "string"]
    with pytest.raises(ValueError, match="unexpected"):
        projection.target_schema_from_dictionary([ColumnSpec("x", "BO")])
    row = {"Column Dictionary Name": " x ", "Type": "D ", "Max Length": "", "Format": None,
           "Decimal Total Digits": "9", "Decimal Fractional Digits": "3"}
    assert ColumnSpec.from_row(row) == ColumnSpec("x", "D", None, None, 9, 3)


def test_cdc_plan_rules(spark):
    tgt = spark.createDataFrame([("A", 5), ("A", 7), ("B", 1)], "t string, c int")
    src = spark.createDataFrame([("A", 7), ("A", 8), ("A", 6), ("B", 1), ("B", 2), ("B", 3), ("N", 1)],
                                "t string, c int")
    plan = {r.t: r for r in planning.cdc_plan(src, tgt, "t", "c", "TPT", cutoff=3).collect()}
    assert plan["A"].hwm == 7 and plan["A"].pending_rows == 2 and plan["A"].strategy == "JDBC"
    assert plan["A"].where_clause == "c >= '7'"
    assert plan["B"].pending_rows == 3 and plan["B"].strategy == "WriteNOS"
    assert plan["N"].hwm is None and plan["N"].strategy == "TPT" and plan["N"].where_clause == ""
    ext = planning.cdc_extract(src, planning.cdc_plan(src, tgt, "t", "c", "TPT", cutoff=3), "t", "c")
    assert rows(ext) == [("A", 7), ("A", 8), ("B", 1), ("B", 2), ("B", 3), ("N", 1)]


def test_load_mode_plan(spark):
    df = spark.createDataFrame([("s.t1", "c.s.t1", "", "id", "JDBC"), ("s.t2", "c.s.t2", "x > 1", "", "WriteNOS"),
                                ("s.t3", "s.t3", "", None, "WriteNOS")],
                               "source_table string, target_table string, where_clause string, primary_key string, "
                               "strategy string")
    got = {r.source_table: r for r in planning.load_mode_plan(df, "stage").collect()}
    assert got["S.T1"].mode == "merge" and got["S.T1"].stage_dir is None and got["S.T1"].names_ok
    assert got["S.T2"].mode == "replace_where" and not got["S.T2"].truncate_first
    assert got["S.T2"].stage_dir == "stage/C/S__T2"
    assert got["S.T3"].mode == "overwrite" and got["S.T3"].truncate_first and not got["S.T3"].names_ok


def test_count_reconcile(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    src = spark.createDataFrame([(2, "b", 20.0), (3, "b", 30.0)], SCHEMA)
    m = count_reconcile("merge", src, tgt, loading.merge_pk(tgt, src, "id"), primary_key="id").first()
    assert (m.payload_rows, m.target_before, m.target_after, m.expected_after, m.ok) == (2, 2, 3, 3, True)
    bad = count_reconcile("merge", src, tgt, tgt, primary_key="id").first()
    assert not bad.ok
    rw = count_reconcile("replace_where", src.where("k2 = 'b'"), tgt, loading.replace_where(tgt, src, "k2 = 'b'"),
                         where="k2 = 'b'").first()
    assert rw.expected_after == 3 and rw.ok


def test_load_report_line(spark):
    h = spark.createDataFrame([("S.A", "WriteNOS", "SUCCESS", dt.datetime(2024, 1, 20, 0, 0),
                                dt.datetime(2024, 1, 20, 0, 7, 0), 12, " boom ")],
                              "source_table string, strategy string, status string, trigger_time timestamp_ntz, "
                              "finish_time timestamp_ntz, num_records bigint, error string")
    r = load_report(h).first()
    assert r.duration_min == 7.0
    assert r.line == "S.A,writenos,SUCCESS,1/19/24 5:00 PM,1/19/24 5:07 PM,7.00,12,boom"


def test_jdbc_options():
    o = jdbc_options("jdbc:x", table="S.T", where="a > 1", partition_column="id", lower_bound=0, upper_bound=9,
                     num_partitions=4, lock_rows=True)
    assert o["dbtable"] == "(SELECT * FROM S.T WHERE a > 1) tm_src" and o["numPartitions"] == "4"
    assert o["prepareQuery"].startswith("LOCKING ROW FOR ACCESS")
    assert jdbc_options("jdbc:x", query="SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_extract_where_pushes_to_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("g")).write.parquet(p)
    plan = planning.extract_where(spark.read.parquet(p), "id >= 50")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,50)]" in plan


def test_content_reconcile(spark):
    a = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    b = spark.createDataFrame([(2, "b", 2.0), (1, "a", 1.0)], SCHEMA)
    c = spark.createDataFrame([(2, "b", 2.5), (1, "a", 1.0)], SCHEMA)
    assert content_reconcile(a, b).first().ok
    assert not content_reconcile(a, c).first().ok
    assert table_checksum(a).first().rows == 2
    by = {r.k2: r.ok for r in content_reconcile(a, c, by="k2").collect()}
    assert by == {"a": True, "b": False}


def test_sinks_strict_append_create_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    p = str(tmp_path / "t")
    assert tables.create_if_absent(spark, p, df.schema) and not tables.create_if_absent(spark, p, df.schema)
    tables.append(df, p, expect_schema=spark.read.parquet(p).schema)
    with pytest.raises(ValueError, match="does not match"):
        tables.append(df.select("id", "k2"), p, expect_schema=spark.read.parquet(p).schema)
    q = str(tmp_path / "parts")
    tables.publish(df, q, partition_by=["k2"])
    tables.replace_partitions(spark.createDataFrame([(9, "b", 9.0)], SCHEMA), q, ["k2"])
    assert rows(spark.read.parquet(q).select("id", "k2", "v")) == [(1, "a", 1.0), (9, "b", 9.0)]


def test_replace_where_in_place_touches_only_matching_partitions(spark, tmp_path):
    import os
    p = str(tmp_path / "parts")
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], SCHEMA)
    tables.publish(tgt, p, partition_by=["k2"])
    before = {d: sorted(os.listdir(os.path.join(p, d))) for d in os.listdir(p) if d.startswith("k2=")}
    src = spark.createDataFrame([(20, "b", 20.0), (30, "c", 30.0), (40, "d", 40.0)], SCHEMA)
    tables.replace_where_in_place(spark, p, src, "k2 IN ('b', 'd')", ["k2"])
    after = {d: sorted(os.listdir(os.path.join(p, d))) for d in os.listdir(p) if d.startswith("k2=")}
    assert after["k2=a"] == before["k2=a"] and after["k2=c"] == before["k2=c"]  # untouched files kept
    assert after["k2=b"] != before["k2=b"] and "k2=d" in after
    assert rows(spark.read.parquet(p).select("id", "k2", "v")) == [(1, "a", 1.0), (3, "c", 3.0), (20, "b", 20.0),
                                                                  (40, "d", 40.0)]


def test_run_load_reports_and_validates(spark):
    from tidemark.plans.flows import LoadPlan, run_load
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    src = spark.createDataFrame([(2, "b", 20.0), (3, "b", 30.0)], SCHEMA)
    ok = run_load(spark, src, tgt, LoadPlan("S.T", "JDBC", primary_key="id"), validate=True)
    rep = ok.report.first()
    assert rep.status == "SUCCESS" and rep.num_records == 2 and rep.strategy == "jdbc" and rep.error == ""
    assert ok.check.first().ok
    assert rows(spark.read.parquet(ok.path)) == [(1, "a", 1.0), (2, "b", 20.0), (3, "b", 30.0)]
    staged = run_load(spark, src, tgt, LoadPlan("S.T", "WriteNOS", primary_key="id"), validate=True)
    assert rows(spark.read.parquet(staged.path)) == [(2, "b", 20.0), (3, "b", 30.0)]  # truncate, then insert
    dup = spark.createDataFrame([(5, "a", 1.0), (5, "b", 2.0)], SCHEMA)
    bad = run_load(spark, dup, tgt, LoadPlan("S.T", "JDBC", primary_key="id"))
    r = bad.report.first()
    assert bad.path is None and r.status == "FAILED" and "duplicate keys" in r.error


def test_merge_in_place_rewrites_touched_partitions_only(spark, tmp_path):
    import os
    p = str(tmp_path / "m")
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], SCHEMA)
    tables.publish(tgt, p, partition_by=["k2"])
    before = {d: sorted(os.listdir(os.path.join(p, d))) for d in os.listdir(p) if d.startswith("k2=")}
    tables.merge_in_place(spark, p, spark.createDataFrame([(2, "b", 20.0), (4, "b", 40.0)], SCHEMA), "id", ["k2"])
    after = {d: sorted(os.listdir(os.path.join(p, d))) for d in os.listdir(p) if d.startswith("k2=")}
    assert after["k2=a"] == before["k2=a"] and after["k2=c"] == before["k2=c"] and after["k2=b"] != before["k2=b"]
    assert rows(spark.read.parquet(p).select("id", "k2", "v")) == [(1, "a", 1.0), (2, "b", 20.0), (3, "c", 3.0),
                                                                  (4, "b", 40.0)]
    with pytest.raises(ValueError, match="partitions"):  # key 1 would move from a to b
        tables.merge_in_place(spark, p, spark.createDataFrame([(1, "b", 9.0)], SCHEMA), "id", ["k2"])


def test_loads_ignore_the_replication_column(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0, 7), (2, "b", 2.0, 7)],
                                SCHEMA + ", REPLICATE_IO_METADATA_VERSION int")
    src = spark.createDataFrame([(2, "b", 20.0), (3, "b", 30.0)], SCHEMA)
    assert rows(loading.merge_pk(tgt, src, "id")) == [(1, "a", 1.0, 7), (2, "b", 20.0, 7), (3, "b", 30.0, None)]
    assert rows(loading.replace_where(tgt, src, "k2 = 'b'")) == [(1, "a", 1.0, 7), (2, "b", 20.0, None),
                                                                (3, "b", 30.0, None)]
    from tidemark.sources.catalog import target_schema
    assert [f.name for f in target_schema(spark, tgt).fields] == ["id", "k2", "v"]


def test_replace_where_in_place_empties_a_partition(spark, tmp_path):
    p = str(tmp_path / "parts")
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "b", 3.0)], SCHEMA)
    tables.publish(tgt, p, partition_by=["k2"])
    src = spark.createDataFrame([(9, "c", 9.0)], SCHEMA)
    tables.replace_where_in_place(spark, p, src, "k2 = 'b'", ["k2"])  # deletes all of b, adds nothing there
    assert rows(spark.read.parquet(p).select("id", "k2", "v")) == [(1, "a", 1.0)]


def test_run_load_full_switch(spark):
    from tidemark.plans.flows import LoadPlan, run_load
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    src = spark.createDataFrame([(2, "b", 20.0)], SCHEMA)  # key 1 was deleted at the source
    keep = run_load(spark, src, tgt, LoadPlan("S.T", "JDBC", primary_key="id"))
    assert rows(spark.read.parquet(keep.path)) == [(1, "a", 1.0), (2, "b", 20.0)]
    full = run_load(spark, src, tgt, LoadPlan("S.T", "JDBC", primary_key="id", full=True))
    assert rows(spark.read.parquet(full.path)) == [(2, "b", 20.0)]


def test_point_view_switches_readers(spark):
    v1 = tables.publish(spark.createDataFrame([(1, "a", 1.0)], SCHEMA), name="t")
    v2 = tables.publish(spark.createDataFrame([(2, "b", 2.0)], SCHEMA), name="t")
    tables.point_view(spark, "tm_target", v1)
    assert [r.id for r in spark.table("tm_target").collect()] == [1]
    tables.point_view(spark, "tm_target", v2)
    assert [r.id for r in spark.table("tm_target").collect()] == [2]
    assert [r.id for r in spark.read.parquet(v1).collect()] == [1]  # the old version is untouched


def test_run_load_publishes_bucketed_target(spark):
    from tidemark.plans.flows import LoadPlan, run_load
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    src = spark.createDataFrame([(2, "b", 20.0), (3, "b", 30.0)], SCHEMA)
    res = run_load(spark, src, tgt, LoadPlan("S.T", "JDBC", primary_key="id"), bucket=("tm_flow_bucketed", 4),
                   validate=True)
    assert res.report.first().status == "SUCCESS" and res.check.first().ok
    assert rows(spark.table("tm_flow_bucketed")) == [(1, "a", 1.0), (2, "b", 20.0), (3, "b", 30.0)]
    assert rows(spark.read.parquet(res.path)) == rows(spark.table("tm_flow_bucketed"))
