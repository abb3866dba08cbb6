"""Feed operators and queue transitions on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import feed as feedops
from tidemark.operators import queue as qops
from tidemark.schemas import ATTRS, HISTORY, QUEUE
from tidemark.sources.feed import incremental_scan

T0 = dt.datetime(2024, 1, 20, 0, 0, 0)


def feed(spark, rows):
    return spark.createDataFrame(rows, "source_table string, event_time timestamp_ntz")


def attrs(spark, rows):
    return spark.createDataFrame(rows, ATTRS)


def test_incremental_scan_half_open_keeps_microseconds(spark):
    f = feed(spark, [("S.A", T0), ("S.B", T0 + dt.timedelta(microseconds=500_000)),
                     ("S.C", T0 + dt.timedelta(hours=1)), ("S.D", T0 + dt.timedelta(hours=2))])
    got = sorted(r.source_table for r in incremental_scan(f, T0, T0 + dt.timedelta(hours=1)).collect())
    assert got == ["S.B", "S.C"]  # the row at the mark is excluded, the .5 s row is not lost


def test_incremental_scan_db_table_and_local_zone(spark):
    tracking = spark.createDataFrame([("SRC", "T1", dt.datetime(2024, 1, 19, 17, 30))],
                                     "db string, tbl string, ts timestamp_ntz")
    # 17:30 Phoenix is 00:30 UTC next day
    out = incremental_scan(tracking, "2024-01-20 00:00:00", "2024-01-20 01:00:00", ts_col="ts", table_col="tbl",
                           db_col="db", local_zone="America/Phoenix").first()
    assert out.source_table == "SRC.T1" and out.event_time == dt.datetime(2024, 1, 20, 0, 30)


def test_coalesce_and_enqueue_records(spark):
    f = feed(spark, [("S.A", T0), ("S.A", T0 + dt.timedelta(minutes=5)), ("S.B", T0), ("S.X", T0)])
    a = attrs(spark, [("S.A", "C.S.A", "cdc", "ts", "id", "JDBC", False, 3, 0, 60),
                      ("S.B", None, "snapshot", None, None, "WriteNOS", False, 1, None, 60),
                      ("S.X", None, "snapshot", None, None, "WriteNOS", True, 1, 0, 60)])
    recs = {r.source_table: r for r in feedops.enqueue_from_feed(f, a, "main").collect()}
    assert set(recs) == {"S.A", "S.B"}  # no attrs / disabled -> dropped
    assert recs["S.A"].target_table == "C.S.A" and recs["S.A"].event_time_latest == T0 + dt.timedelta(minutes=5)
    assert recs["S.B"].target_table == "main.S.B" and recs["S.B"].event_time_latest is None
    assert recs["S.B"].primary_key == "" and recs["S.A"].status == "Q" and recs["S.A"].lock_rows


def test_validate_attrs_rules(spark):
    raw = spark.createDataFrame([
        ("S.A", "", "s", None, None, "JDBC", "false", 1, None, 60),
        ("S.B", "C.S.B", "s", None, None, "JDBC", " TRUE ", 1, 5, 60),
        ("badtable", "", "s", None, None, "JDBC", "false", 1, 0, 60),
        ("S.C", "", "s", None, None, "BadMethod", "false", 1, 0, 60),
        ("S.D", "", "s", None, None, "TPT", "notabool", 1, 0, 60),
        ("S.E", "", "s", None, None, "TPT", "false", 1, 0, None),
        ("S.F", "", "s", None, None, "TPT", "false", 1, 0, 60),
        ("S.F", "", "s", None, None, "TPT", "false", 1, 0, 60),
    ], "source_table string, target_table string, ingestion_strategy string, cdc_watermark string, "
       "primary_key string, strategy string, disabled string, priority int, min_staleness int, max_staleness int")
    out = {}
    for r in feedops.validate_attrs(raw).collect():
        out.setdefault(r.source_table, r)
    assert out["S.A"].valid and out["S.A"].target_table == "S.A" and out["S.A"].min_staleness == 0
    assert out["S.A"].disabled is False and out["S.B"].disabled is True and out["S.B"].valid
    assert "2 or 3" in out["badtable"].reject_reason
    assert "strategy" in out["S.C"].reject_reason
    assert "disabled" in out["S.D"].reject_reason
    assert "max_staleness" in out["S.E"].reject_reason
    assert "duplicate" in out["S.F"].reject_reason


def q(spark, rows):
    full = [(s, "C." + s, "", "", et, tt, "JDBC", True, st, p, lt) for s, et, tt, st, p, lt in rows]
    return spark.createDataFrame(full, QUEUE)


def test_queue_upsert_rules_and_idempotence(spark):
    queue = q(spark, [("S.A", T0, None, "Q", 1, None), ("S.R", T0, T0, "R", 1, None)])
    f = feed(spark, [("S.A", T0 + dt.timedelta(hours=1)), ("S.R", T0 + dt.timedelta(hours=1)),
                     ("S.N", T0 + dt.timedelta(hours=2))])
    a = attrs(spark, [(s, None, "s", None, None, "JDBC", False, 5, 0, 60) for s in ("S.A", "S.R", "S.N")])
    recs = feedops.enqueue_from_feed(f, a, "main")
    once = qops.queue_upsert(queue, recs)
    rows = sorted((r.source_table, r.status, r.priority, r.event_time, r.event_time_latest) for r in once.collect())
    assert rows == [
        ("S.A", "Q", 5, T0, T0 + dt.timedelta(hours=1)),               # matched: priority + latest
        ("S.N", "Q", 5, T0 + dt.timedelta(hours=2), None),             # inserted
        ("S.R", "Q", 5, T0 + dt.timedelta(hours=1), None),             # running row does not match
        ("S.R", "R", 1, T0, None),
    ]


def test_stream_batch_replay_is_idempotent(spark, tmp_path):
    """A replayed micro-batch reads the version before it, so it rewrites the same version."""
    from tidemark.streaming.enqueue import INITIAL_VERSION, QueueEnqueueBatch, publish_version, read_version

    root = str(tmp_path / "queue")
    publish_version(q(spark, [("S.A", T0, None, "Q", 1, None)]), root, INITIAL_VERSION)
    a = attrs(spark, [(s, None, "s", None, None, "JDBC", False, 5, 0, 60) for s in ("S.A", "S.N")])
    batch = feed(spark, [("S.A", T0 + dt.timedelta(hours=1)), ("S.N", T0 + dt.timedelta(hours=2))])
    body = QueueEnqueueBatch(a, "main", root)
    body(batch, 0)
    first = sorted(map(tuple, read_version(spark, root, 0).collect()))
    body(batch, 0)  # replay after a failure
    assert sorted(map(tuple, read_version(spark, root, 0).collect())) == first
    body(feed(spark, [("S.N", T0 + dt.timedelta(hours=3))]), 1)
    latest = {r.source_table: r.event_time_latest for r in read_version(spark, root).collect()}
    assert latest == {"S.A": T0 + dt.timedelta(hours=1), "S.N": T0 + dt.timedelta(hours=3)}
    body(feed(spark, [("S.A", T0 - dt.timedelta(hours=1)), ("S.Q", T0 + dt.timedelta(hours=4))]), 2)  # one late row
    from tidemark.streaming.enqueue import read_metrics
    m = {r.batch_id: (r.rows, r.late_rows) for r in read_metrics(spark, root).collect()}
    assert m == {0: (2, 0), 1: (1, 0), 2: (2, 1)}


def test_batch_upsert_validation_and_defaults(spark):
    queue = q(spark, [("S.A", T0, T0, "R", 7, T0)])
    with pytest.raises(ValueError, match="required"):
        qops.prepare_batch(spark.createDataFrame([("S.A",)], "source_table string"), "main", T0)
    with pytest.raises(ValueError, match="not allowed"):
        qops.prepare_batch(spark.createDataFrame([("S.A", "JDBC", 1)], "source_table string, strategy string, x int"),
                           "main", T0)
    frame = spark.createDataFrame([("S.A", "WriteNOS"), ("S.B", "JDBC")], "source_table string, strategy string")
    got = {r.source_table: r for r in qops.queue_batch_upsert(queue, frame, "main", "2024-01-21 00:00:00").collect()}
    assert got["S.A"].status == "Q" and got["S.A"].strategy == "WriteNOS" and got["S.A"].priority == 1
    assert got["S.A"].trigger_time == T0 and got["S.A"].event_time_latest == T0  # kept
    assert got["S.B"].target_table == "main.S.B" and got["S.B"].event_time == dt.datetime(2024, 1, 21)


def hist(spark, rows):
    full = [(s, None, None, None, st, et, None, None, None, None, None, None, None, n) for s, et, st, n in rows]
    return spark.createDataFrame(full, HISTORY)


def test_claim_then_complete(spark):
    queue = q(spark, [("S.A", T0, None, "Q", 1, None), ("S.B", T0, None, "Q", 1, None),
                      ("S.C", T0, None, "Q", 1, None)])
    history = hist(spark, [("S.B", T0, "SUCCESS", 10), ("S.C", T0, "RUNNING", None), ("S.Z", T0, "FAILED", 1)])
    claims = queue.select("source_table", "target_table", "where_clause", "primary_key", "event_time", "strategy",
                          "lock_rows", "priority")
    now = "2024-01-20 01:00:00"
    q2 = qops.queue_after_claim(queue, claims.where(F.col("source_table") != "S.C"), now)
    assert {r.source_table: r.status for r in q2.collect()} == {"S.A": "R", "S.B": "R", "S.C": "Q"}
    h2 = {r.source_table: r for r in qops.history_after_claim(history, claims, now).collect()}
    assert h2["S.A"].status == "RUNNING" and h2["S.B"].status == "RUNNING" and h2["S.B"].num_records is None
    assert h2["S.C"].status == "RUNNING" and h2["S.Z"].status == "FAILED"
    done = spark.createDataFrame([("S.A", T0, "FAILED", dt.datetime(2024, 1, 20, 1, 30), 30.0, 0, "can't")],
                                 "source_table string, event_time timestamp_ntz, status string, "
                                 "finish_time timestamp_ntz, duration_min double, num_records bigint, error string")
    q3 = qops.queue_after_complete(q2, done)
    assert sorted(r.source_table for r in q3.collect()) == ["S.B", "S.C"]
    h3 = {r.source_table: r for r in qops.history_after_complete(qops.history_after_claim(history, claims, now),
                                                                 done).collect()}
    assert h3["S.A"].status == "FAILED" and h3["S.A"].error == "cant" and h3["S.A"].duration_min == 30.0


def test_requeue_key_check_length_watermark(spark):
    queue = q(spark, [("S.A", T0, T0, "R", 1, None), ("S.A", T0 + dt.timedelta(hours=1), None, "Q", 1, None),
                      ("S.B", T0, None, "Q", 1, T0 + dt.timedelta(hours=3))])
    history = hist(spark, [("S.A", T0, "RUNNING", None), ("S.Z", T0 + dt.timedelta(hours=2), "SUCCESS", 1)])
    re_q = qops.requeue_running_queue(queue)
    assert [r.source_table for r in qops.queue_key_check(re_q).collect()] == ["S.A"]
    assert qops.requeue_running_history(history, queue).count() == 1
    assert qops.queue_length(queue).first().queued == 2
    assert qops.resume_watermark(queue, history).first().watermark == T0 + dt.timedelta(hours=3)
    empty_q, empty_h = spark.createDataFrame([], QUEUE), spark.createDataFrame([], HISTORY)
    wm = qops.resume_watermark(empty_q, empty_h, start="2024-01-01 00:00:00").first().watermark
    assert wm == dt.datetime(2024, 1, 1)
    assert qops.queue_reset(queue).count() == 0


def test_salted_enrich_equals_plain_join(spark):
    hot = [("S.H", T0 + dt.timedelta(seconds=i)) for i in range(300)]
    f = feed(spark, hot + [("S.A", T0), ("S.X", T0)])
    a = attrs(spark, [("S.H", None, "s", None, None, "JDBC", False, 1, 0, 60),
                      ("S.A", None, "s", None, None, "TPT", False, 2, 0, 60)])
    plain = sorted(map(tuple, feedops.enrich(f, a).collect()))
    salted = feedops.enrich(f, a, salt_buckets=8)
    assert sorted(map(tuple, salted.select(*feedops.enrich(f, a).columns).collect())) == plain
    assert len(plain) == 301


def test_batch_upsert_parses_local_text_times(spark):
    queue = spark.createDataFrame([], QUEUE)
    kind = "source_table string, strategy string, event_time string"
    frame = spark.createDataFrame([("S.A", "JDBC", "2024-01-19 17:00:00"), ("S.B", "JDBC", None)], kind)
    got = {r.source_table: r.event_time for r in
           qops.queue_batch_upsert(queue, frame, "main", "2024-01-21 00:00:00", local_zone="America/Phoenix").collect()}
    assert got == {"S.A": dt.datetime(2024, 1, 20, 0, 0), "S.B": dt.datetime(2024, 1, 21, 0, 0)}  # no time -> as_of
    bad = spark.createDataFrame([("S.B", "JDBC", "2024-01-19T17:00:00Z")], kind)
    with pytest.raises(Exception, match="not an event time"):
        qops.queue_batch_upsert(queue, bad, "main", "2024-01-21 00:00:00", local_zone="America/Phoenix").collect()
    twice = spark.createDataFrame([("S.A", "JDBC", None), ("S.A", "JDBC", None)], kind)
    with pytest.raises(ValueError, match="more than once"):
        qops.queue_batch_upsert(queue, twice, "main", "2024-01-21 00:00:00")


def test_late_record_does_not_move_the_latest_time_back(spark):
    day = dt.datetime(2024, 1, 20)
    row = ("S.A", "S.A", "", "", day, None, "JDBC", True, "Q", 1, day + dt.timedelta(hours=5))
    late = ("S.A", "S.A", "", "", day - dt.timedelta(days=1), None, "JDBC", True, "Q", 2, None)
    got = qops.queue_upsert(spark.createDataFrame([row], QUEUE), spark.createDataFrame([late], QUEUE)).collect()
    assert [(r.priority, r.event_time_latest) for r in got] == [(2, day + dt.timedelta(hours=5))]


def test_stream_first_start_skips_through_the_mark(spark, tmp_path):
    from tidemark.schemas import FEED
    from tidemark.streaming.enqueue import read_version, start_enqueue
    feed_dir, root, ckpt = str(tmp_path / "feed"), str(tmp_path / "queue"), str(tmp_path / "ckpt")
    feed(spark, [("S.A", T0), ("S.B", T0 + dt.timedelta(hours=2))]).write.parquet(feed_dir)
    a = attrs(spark, [(s, None, "s", None, None, "JDBC", False, 1, 0, 60) for s in ("S.A", "S.B")])
    start_enqueue(spark, feed_dir, FEED, a, "main", root, ckpt, initial_queue=spark.createDataFrame([], QUEUE),
                  skip_through=T0 + dt.timedelta(hours=1)).awaitTermination()
    assert [r.source_table for r in read_version(spark, root).collect()] == ["S.B"]


def test_a_new_checkpoint_goes_on_with_the_existing_queue(spark, tmp_path):
    from tidemark.schemas import FEED
    from tidemark.streaming.enqueue import published_versions, read_version, start_enqueue, version_path
    root, names = str(tmp_path / "queue"), ("S.A", "S.B", "S.C")
    a = attrs(spark, [(s, None, "s", None, None, "JDBC", False, 1, 0, 60) for s in names])

    def run(name, ckpt):
        feed(spark, [(name, T0)]).write.mode("append").parquet(str(tmp_path / f"feed_{ckpt}"))
        start_enqueue(spark, str(tmp_path / f"feed_{ckpt}"), FEED, a, "main", root, str(tmp_path / ckpt),
                      initial_queue=spark.createDataFrame([], QUEUE)).awaitTermination()
        return sorted(r.source_table for r in read_version(spark, root).collect())

    assert run("S.A", "one") == ["S.A"]
    assert run("S.B", "two") == ["S.A", "S.B"]
    assert run("S.C", "two") == ["S.A", "S.B", "S.C"]  # a restart keeps its numbers
    assert published_versions(spark, root) == [-1, 0, 1, 2]
    feed(spark, [("S.X", T0)]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        version_path(root, 3))
    assert published_versions(spark, root) == [-1, 0, 1, 2]  # an unfinished version is not read


def test_attr_lines_arity_and_text_fields(spark):
    lines = spark.createDataFrame([
        ("SRC.A,,snapshot,,id,JDBC,false,2,,120",),
        ("SRC.B,LAKE.SRC.B,cdc,upd_ts,,WriteNOS,TRUE,1,30,600",),
        ("SRC.C,,snapshot,,,JDBC,false",),
        ("SRC.D,,snapshot,,,JDBC,false,x,0,60",),
    ], "value string")
    out = {r.source_table: r for r in feedops.validate_attrs(feedops.attrs_from_lines(lines)).collect()}
    assert out["SRC.A"].valid and out["SRC.A"].target_table == "SRC.A" and out["SRC.A"].min_staleness == 0
    assert out["SRC.B"].valid and out["SRC.B"].disabled is True and out["SRC.B"].priority == 1
    assert "10 fields" in out["SRC.C"].reject_reason
    assert "priority" in out["SRC.D"].reject_reason


def test_quotes_in_values_are_kept(spark):
    queue = spark.createDataFrame([], QUEUE)
    f = feed(spark, [("S.A", T0)])
    a = attrs(spark, [("S.A", "C.S.A", "s", None, "i'd", "WriteNOS", False, 1, 0, 60)])
    out = qops.queue_upsert(queue, feedops.enqueue_from_feed(f, a, "main")).first()
    assert out.primary_key == "i'd"


def test_enqueue_records_take_the_cdc_plan(spark):
    f = feed(spark, [("S.A", T0), ("S.B", T0)])
    a = attrs(spark, [("S.A", None, "cdc", "upd", None, "WriteNOS", False, 1, 0, 60),
                      ("S.B", None, "snapshot", None, None, "WriteNOS", False, 1, 0, 60)])
    plan = spark.createDataFrame([("S.A", "JDBC", "upd >= '2024-01-01 00:00:00'")],
                                 "source_table string, strategy string, where_clause string")
    recs = {r.source_table: r for r in feedops.enqueue_from_feed(f, a, "main", plan).collect()}
    assert (recs["S.A"].strategy, recs["S.A"].where_clause) == ("JDBC", "upd >= '2024-01-01 00:00:00'")
    assert (recs["S.B"].strategy, recs["S.B"].where_clause) == ("WriteNOS", "")


def test_missing_queue_has_length_zero(spark, tmp_path):
    from tidemark.sinks.tables import read_or_empty
    q = read_or_empty(spark, str(tmp_path / "nope"), QUEUE)
    assert qops.queue_length(q).first().queued == 0
