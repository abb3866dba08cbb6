"""Merges of touched files, differences, rejects, sized exports, read splits, plans from file statistics."""

import datetime as dt
import os
import random
import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tests.conftest import SF_SMALL
from tidemark.operators import feed as feedops
from tidemark.operators import loading, marks, ranking
from tidemark.operators.differences import find_differences
from tidemark.plans import flows, registry
from tidemark.plans.fixtures import Fixtures
from tidemark.schemas import ATTRS, FEED
from tidemark.sinks import tables
from tidemark.sources.splits import read_splits, split_counts

VERSION = loading.REPLICATION_COLUMN


def files(path):
    return {f: os.stat(f"{path}/{f}").st_mtime_ns for f in os.listdir(path) if f.endswith(".parquet")}


def test_only_touched_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "target")
    target = spark.createDataFrame([(i if i % 20 else None, f"v{i}", i) for i in range(100)], f"id long, v string, {VERSION} long")
    target.repartitionByRange(5, F.coalesce("id", F.lit(-1))).write.parquet(path)
    before = files(path)
    payload = spark.createDataFrame([(41, "new"), (43, "new"), (500, "add"), (None, "add")], "id long, v string")
    touched = tables.merge_touched_files(spark, path, payload, "id")
    after = files(path)
    assert len(before) == 5 and len(touched) == 1
    kept = {f: t for f, t in before.items() if f in after}
    assert len(kept) == 4 and all(after[f] == t for f, t in kept.items())
    got = Counter((r.id, r.v, r[VERSION]) for r in spark.read.parquet(path).collect())
    want = Counter((i if i % 20 else None, "new" if i in (41, 43) else f"v{i}", i) for i in range(100))
    assert got == want + Counter([(500, "add", None), (None, "add", None)])
    with pytest.raises(ValueError):
        tables.merge_touched_files(spark, path, payload.unionByName(payload), "id")
    assert files(path) == after


def test_touched_files_of_a_partitioned_target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.createDataFrame([(i, f"v{i}", i % 3) for i in range(30)], "id long, v string, p int").write.partitionBy("p").parquet(path)
    payload = spark.createDataFrame([(4, "moved", 2), (77, "add", 9)], "id long, v string, p int")
    tables.merge_touched_files(spark, path, payload, "id", ["p"])
    got = {(r.id, r.v, r.p) for r in spark.read.parquet(path).collect()}
    assert got == {(i, f"v{i}", i % 3) for i in range(30) if i != 4} | {(4, "moved", 2), (77, "add", 9)}
    assert spark.read.parquet(path).count() == 31


def test_merge_keeps_columns_the_payload_lacks_and_never_multiplies(spark, tmp_path):
    target = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "c", 1)], f"id long, v string, {VERSION} long")
    payload = spark.createDataFrame([(1, "new"), (3, "add")], "id long, v string")
    got = sorted(tuple(r) for r in loading.merge_pk(target, payload, "id").collect())
    assert got == [(1, "new", 7), (2, "c", 1), (3, "add", None)]
    path = str(tmp_path / "t")
    target.where("id = 2").withColumn("p", F.lit(1)).write.partitionBy("p").parquet(path)
    tables.merge_in_place(spark, path, spark.createDataFrame([(2, "new", 1)], "id long, v string, p int"), "id", ["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(2, "new", 1, 1)]


def test_differences_with_null_and_repeated_keys(spark):
    schema = "k long, s string, v double, w string"
    rng = random.Random(2)
    base = [(i % 50 if i % 9 else None, rng.choice("ab"), float(i), rng.choice(["x", None])) for i in range(200)]
    s = spark.createDataFrame(base, schema).repartition(3)
    assert find_differences(s, s.repartition(5), "k,s", coarse=8, fine=4).isEmpty()
    other = [r if i != 30 else (*r[:2], -1.0, "y") for i, r in enumerate(base) if i != 77] + [(900, "z", 1.0, None)]
    got = {(r.k, r.s): (r.difference, r.changed_columns) for r in
           find_differences(s, spark.createDataFrame(other, schema), "k,s", coarse=8, fine=4).collect()}
    a, b = Counter(base), Counter(other)
    keys = {r[:2] for r in (a - b) | (b - a)}
    left, right = {r[:2] for r in base}, {r[:2] for r in other}
    assert set(got) == keys
    for k, (kind, _) in got.items():
        assert kind == ("missing" if k not in right else "extra" if k not in left else "changed")
    assert set(got[base[30][:2]][1]) <= {"v", "w"} and "v" in got[base[30][:2]][1]
    assert find_differences(s.limit(0), s.limit(0), "k").isEmpty()


def test_rows_of_equal_buckets_are_not_shuffled(spark, tmp_path):
    base = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    base.write.parquet(str(tmp_path / "a"))
    base.withColumn("v", F.when(F.col("k") == 99, -1).otherwise(F.col("v"))).write.parquet(str(tmp_path / "b"))
    df = find_differences(spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b")), "k", coarse=64, fine=64)
    assert [tuple(r)[:2] for r in df.collect()] == [(99, "changed")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4  # both sides are cut to unequal buckets before any key is placed
    lines = plan.splitlines()
    first = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert any("LeftSemi" in x for x in lines[first:])


def test_rejects_of_a_load(spark):
    target = spark.createDataFrame([(9, dt.date(2020, 1, 1))], "id long, day date")
    source = spark.createDataFrame([("1", "2024-01-02"), ("x", "2024-01-02"), ("3", "no"), (None, None)], "id string, day string")
    plain = flows.run_load(spark, source, target, flows.LoadPlan("S.T", "JDBC"))
    assert plain.status == "FAILED" and plain.path is None
    res = flows.run_load(spark, source, target, flows.LoadPlan("S.T", "JDBC"), keep_rejects=True)
    assert (res.status, res.num_records, res.rejected) == ("SUCCESS", 2, 2)
    assert {r.id for r in spark.read.parquet(res.path).collect()} == {1, None}
    assert {r.reject_reason for r in res.rejects.collect()} == {"id is not bigint", "day is not date"}
    assert '"x"' in " ".join(r.raw for r in res.rejects.collect())
    good = flows.run_load(spark, source.where("id = '1'"), target, flows.LoadPlan("S.T", "JDBC"), keep_rejects=True)
    assert good.rejected == 0 and good.rejects.isEmpty()


def test_claims_that_cannot_be_loaded_are_completed_as_failed(spark):
    claims = spark.createDataFrame([("S.A", "m.S.A", "", "id", dt.datetime(2024, 1, 1), "JDBC"), ("S.B", "m.S.B", "", "", dt.datetime(2024, 1, 2), "JDBC"),
                                    ("S.C", "m.S.C", "bad >", "", dt.datetime(2024, 1, 3), "JDBC")],
                                   "source_table string, target_table string, where_clause string, primary_key string, event_time timestamp_ntz, strategy string")
    data = spark.range(3)

    def resolve(source, target):
        if source == "S.B":
            raise LookupError("gone")
        return data, data.limit(0)

    done, results = flows.load_claims(spark, claims, resolve)
    got = {r.source_table: r for r in done.collect()}
    assert got["S.A"].status == "SUCCESS" and got["S.A"].num_records == 3 and got["S.A"].duration_min >= 0
    assert got["S.B"].status == "FAILED" and "gone" in got["S.B"].error and got["S.B"].finish_time is not None
    assert got["S.C"].status == "FAILED" and results["S.C"].path is None


def test_sized_export(spark):
    rows = spark.range(0, 30_000, numPartitions=13).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    path, n, width = tables.export_sized(rows, target_bytes=300_000, probe_rows=5000)
    sizes = tables.folder_bytes(spark, path)
    assert n == 30_000 and width > 30 and all(200_000 < s < 400_000 for s in sizes)
    path, n, _ = tables.export_sized(rows.limit(0))
    assert n == 0 and spark.read.parquet(path).count() == 0


def test_sized_export_query_has_more_files_of_a_larger_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "STAGE_OBJECT_BYTES", 200_000)  # a large table has many objects' bytes
    made, export = [], tables.export_sized
    monkeypatch.setattr(tables, "export_sized", lambda df, *a, **k: made.append(export(df, *a, **k)) or made[-1])
    orders = spark.range(4000).select(F.col("id").alias("o_orderkey"), F.sha2(F.col("id").cast("string"), 256).alias("o_comment"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(tuple(r) for r in registry.queries()["stage_export_sized"](spark, str(tmp_path)).collect())
    assert got == [("narrow", 4000, True), ("wide", 4000, True)]
    sizes = [tables.folder_bytes(spark, path) for path, _, _ in made]
    assert len(sizes[1]) == 6 and len(sizes[3]) > 6 and max(sizes[3]) < 300_000


def test_large_exports_are_dealt_in_parts(spark, tmp_path, monkeypatch):
    work = str(tmp_path / "work")
    monkeypatch.setattr(tables, "work_path", lambda spark, *parts: "/".join([work, *parts, uuid.uuid4().hex]))
    keep = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def local_bytes():
        return sum(os.path.getsize(f) for f in keep.getAllFiles().mkString("\n").split("\n") if os.path.isfile(f))

    # wide rows lie together, some are null or repeated, and partitions are uneven
    rows = spark.range(0, 60_000, numPartitions=3).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 50_000).alias("id"),
        F.sha2(F.when(F.col("id") < 55_000, F.col("id")).cast("string"), 512).alias("h"),
        F.when(F.col("id") < 12_000, F.sha2((-F.col("id")).cast("string"), 512)).alias("w")).where("id is null or id < 20000 or id > 25000")
    want = Counter(map(tuple, rows.collect()))
    dealt, deal = [], tables._deal

    def seen(df, *a, **k):
        n = deal(df, *a, **k)
        dealt.append((n, sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{work}/stage_parts") for f in names)))
        return n

    monkeypatch.setattr(tables, "_deal", seen)
    before = local_bytes()
    path, n, width = tables.export_sized(rows, target_bytes=40_000, probe_rows=60_000)
    assert Counter(map(tuple, spark.read.parquet(path).collect())) == want and n == sum(want.values())
    sizes = tables.folder_bytes(spark, path)
    assert len(sizes) == round(n * width / 40_000) and max(sizes) < 1.25 * min(sizes)
    assert len(dealt) == tables.EXPORT_PARTS and max(r for r, _ in dealt) < 1.1 * n / tables.EXPORT_PARTS
    copies = [b for _, b in dealt]
    assert copies == sorted(copies, reverse=True) and len(set(copies)) == tables.EXPORT_PARTS  # each part goes once it is written
    assert os.listdir(f"{work}/stage_parts") == [] and os.path.exists(f"{path}/_SUCCESS")
    for _ in range(100):  # shuffle files go in the background
        if local_bytes() - before < sum(sizes) / 2:
            break
        time.sleep(0.1)
    assert local_bytes() - before < sum(sizes) / 2
    with pytest.raises(AnalysisException):
        tables.export_sized(spark.read.parquet(path), path, target_bytes=40_000)
    assert sum(tables.folder_bytes(spark, path)) == sum(sizes)
    again = tables.export_sized(rows.where("id < 20000"), path, target_bytes=20_000)[1]
    assert again == spark.read.parquet(path).count() == sum(c for r, c in want.items() if r[0] is not None and r[0] < 20_000)


def test_a_failed_part_leaves_no_mark_of_a_finished_export(spark, tmp_path, monkeypatch):
    deal, path = tables._deal, str(tmp_path / "out")

    def fails(df, path, files, mode="overwrite", last=True):
        if last:
            raise RuntimeError("no disk")
        return deal(df, path, files, mode, last)

    monkeypatch.setattr(tables, "_deal", fails)
    own = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    with pytest.raises(RuntimeError):
        tables.export_sized(rows, path, target_bytes=20_000)
    assert tables.folder_bytes(spark, path) and not os.path.exists(f"{path}/_SUCCESS")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == own


def test_sized_export_query_keeps_one_export_of_a_kind(spark, tmp_path, monkeypatch):
    made, export = [], tables.export_sized
    monkeypatch.setattr(tables, "export_sized", lambda df, *a, **k: made.append(export(df, *a, **k)) or made[-1])
    spark.range(500).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(tuple(r) for r in registry.queries()["stage_export_sized"](spark, str(tmp_path)).collect())
    assert [r[:2] for r in got] == [("narrow", 500), ("wide", 500)]
    assert len(made) == 4 and len({path for path, _, _ in made}) == 2


@pytest.mark.parametrize("kind", ["cubes", "heavy", "nulls", "days", "one", "empty"])
def test_splits_take_every_row_once(spark, kind):
    rng = random.Random(7)
    values = {"cubes": [i ** 3 for i in range(2000)], "heavy": [5 if i % 2 else i for i in range(2000)],
              "nulls": [None if i % 3 else i for i in range(900)], "days": [dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(3000)) for _ in range(2000)],
              "one": [4] * 100, "empty": []}[kind]
    df = spark.createDataFrame([(v,) for v in values], f"c {'date' if kind == 'days' else 'long'}").repartition(4)
    splits = read_splits(df, "c", 8)
    counts = split_counts(df, splits).collect()
    assert sum(r.rows for r in counts) == sum(r.satisfied for r in counts) == len(values)
    assert all(df.where(r.predicate).count() == r.rows for r in counts)
    if kind in ("cubes", "days"):
        assert max(r.rows for r in counts) <= 1.1 * len(values) / 8 + 8


def test_read_splits_of_large_and_null_keys(spark, tmp_path):
    keys = [None, -9_000_000, 9_000_000_000, 2 ** 63 - 1, *range(9_000_000, 9_003_000)]  # their cubes are no bigints
    lines = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(i % 700)) for i, k in enumerate(keys)],
                                  "l_orderkey long, l_shipdate timestamp_ntz")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = sorted(tuple(r) for r in registry.queries()["read_splits"](spark, str(tmp_path)).collect())
    assert got == [(kind, len(keys), len(keys), True) for kind in ("heavy", "shipdate", "skewed")]


def test_splits_of_text_are_refused(spark):
    with pytest.raises(ValueError):
        read_splits(spark.createDataFrame([("a",)], "c string"), "c", 4)


def test_marks_come_from_footers_and_errors_stay_with_their_table(spark, tmp_path):
    for name, hi in (("a", 50), ("b", 0)):
        spark.range(hi).select("id", F.lit(dt.date(2024, 1, 1)).alias("d")).write.parquet(str(tmp_path / name))
    spark.range(80).select("id", F.lit(dt.date(2024, 1, 5)).alias("d")).write.parquet(str(tmp_path / "source"))
    os.makedirs(tmp_path / "broken")
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    session = marks.footer_session(spark)
    plan = marks.table_mark(session, str(tmp_path / "a"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is left alone
    specs = [marks.TableSpec(f"S.{n}", str(tmp_path / "source"), str(tmp_path / n), c, "TPT")
             for n, c in (("a", "id"), ("b", "id"), ("broken", "id"), ("missing", "id"))]
    specs += [marks.TableSpec("S.column", str(tmp_path / "source"), str(tmp_path / "a"), "nope", "TPT"),
              marks.TableSpec("S.full", "", "", None, "WriteNOS"),
              marks.TableSpec("S.day", str(tmp_path / "source"), str(tmp_path / "a"), "d", "TPT")]
    got = {r.source_table[2:]: r for r in marks.plan_tables(spark, specs, cutoff=40).collect()}
    assert (got["a"].strategy, got["a"].where_clause, got["a"].pending_rows) == ("JDBC", "id >= '49'", 31)
    assert (got["day"].strategy, got["day"].where_clause) == ("WriteNOS", "d >= '2024-01-01'")
    for n in ("b", "broken", "missing", "column"):
        assert (got[n].strategy, got[n].where_clause, got[n].hwm) == ("TPT", "", None)
    assert got["b"].error is None and got["broken"].error and got["missing"].error and got["column"].error
    assert got["full"].strategy == "WriteNOS" and marks.plan_tables(spark, []).isEmpty()


def test_duplicate_attributes_give_no_second_record(spark):
    attrs = spark.createDataFrame([("A.T1", None, None, None, None, "JDBC", False, 1, 0, 60)] * 2
                                  + [("A.T2", None, None, None, None, "JDBC", False, 1, None, 60)]
                                  + [("A.T3", None, None, None, None, "JDBC", d, 1, 0, 60) for d in (True, False)], ATTRS)
    feed = spark.createDataFrame([(f"A.T{i}", dt.datetime(2024, 1, 1)) for i in (1, 2, 3, 4)], FEED)
    assert sorted(r.source_table for r in feedops.enqueue_from_feed(feed, attrs, "main").collect()) == ["A.T2", "A.T3"]
    assert [tuple(r) for r in feedops.enqueue_rejects(feed, attrs).collect()] == [("A.T1", "duplicate source_table")]


def test_attribute_lines_with_a_composite_key(spark):
    lines = spark.createDataFrame([('A.T1,,cdc,ts,"a, b",JDBC,false,1,0,60',), ("A.T2,,cdc,ts,a,JDBC,false,1,0",),
                                   ("A.T3,,cdc,ts,a,b,JDBC,false,1,0,60",), ("",), (None,)], "value string")
    got = feedops.validate_attrs(feedops.attrs_from_lines(lines)).collect()
    assert [(r.source_table, r.primary_key) for r in got if r.valid] == [("A.T1", "a, b")]
    assert len(got) == 5 and all("line must have 10 fields" in r.reject_reason for r in got if not r.valid)


@pytest.mark.parametrize("minutes", [0, 1, 7, 300, 100_000])
def test_changed_priorities_against_two_rankings(spark, minutes):
    fx = Fixtures(spark, SF_SMALL)
    start = dt.datetime(2024, 1, 19, 0, 0, 30)
    end = start + dt.timedelta(minutes=minutes, seconds=10)
    weights = [{(r.source_table, r.event_time): r.priority for r in ranking.eligible(fx.queue, fx.attrs, str(t)).collect()}
               for t in (start, end)]
    want = {k: (weights[0].get(k), weights[1].get(k)) for k in weights[0].keys() | weights[1].keys()
            if weights[0].get(k) != weights[1].get(k)}
    got = {(r.source_table, r.event_time): (r.before, r.after)
           for r in ranking.changed_priorities(fx.queue, fx.attrs, str(start), str(end)).collect()}
    assert got == want and (want or minutes < 2)
