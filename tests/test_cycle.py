"""The user-facing cycle API end to end on small control tables."""

import datetime as dt

from tidemark.plans import cycle
from tidemark.schemas import ATTRS, HISTORY, QUEUE
from tidemark.sinks import tables


def test_enqueue_dispatch_complete(spark, tmp_path):
    qpath, hpath = str(tmp_path / "queue"), str(tmp_path / "history")
    assert tables.create_if_absent(spark, qpath, QUEUE) and tables.create_if_absent(spark, hpath, HISTORY)
    queue, history = spark.read.parquet(qpath), spark.read.parquet(hpath)
    attrs = spark.createDataFrame([("SRC.A", "LAKE.SRC.A", "snapshot", None, "id", "JDBC", False, 2, 0, 600),
                                   ("SRC.B", None, "snapshot", None, None, "WriteNOS", False, 1, 0, 600),
                                   ("SRC.C", None, "snapshot", None, None, "TPT", False, 1, 0, 600)], ATTRS)
    tracking = spark.createDataFrame(
        [("SRC", "A", dt.datetime(2024, 1, 19, 16, 0)), ("SRC", "A", dt.datetime(2024, 1, 19, 16, 30)),
         ("SRC", "B", dt.datetime(2024, 1, 19, 16, 10)), ("SRC", "C", dt.datetime(2024, 1, 19, 16, 20)),
         ("SRC", "Z", dt.datetime(2024, 1, 19, 16, 20))],
        "ObjectDatabaseName string, ObjectTableName string, LoadCompletionTS timestamp_ntz")
    mark = cycle.resume_mark(queue, history, start="2024-01-19 00:00:00")
    assert mark == dt.datetime(2024, 1, 19)
    now = "2024-01-20 01:00:00"  # 18:00 in Phoenix
    queue = cycle.enqueue(queue, tracking, attrs, "main", mark, now, db_col="ObjectDatabaseName",
                          table_col="ObjectTableName", ts_col="LoadCompletionTS", local_zone="America/Phoenix")
    q = {r.source_table: r for r in queue.collect()}
    assert set(q) == {"SRC.A", "SRC.B", "SRC.C"}  # SRC.Z has no attributes
    assert q["SRC.A"].event_time == dt.datetime(2024, 1, 19, 23, 0)  # 16:00 Phoenix as UTC
    assert q["SRC.A"].event_time_latest == dt.datetime(2024, 1, 19, 23, 30)
    assert q["SRC.B"].target_table == "main.SRC.B"
    d = cycle.dispatch(queue, history, attrs, now, {"JDBC": 1, "WriteNOS": 1})
    assert {(r.source_table, r.worker) for r in d.claims.collect()} == {("SRC.A", "JDBC"), ("SRC.B", "WriteNOS")}
    qpath2 = tables.publish(d.queue, name="queue")
    hpath2 = tables.publish(d.history, name="history")
    queue, history = spark.read.parquet(qpath2), spark.read.parquet(hpath2)
    assert {r.source_table: r.status for r in queue.collect()} == {"SRC.A": "R", "SRC.B": "R", "SRC.C": "Q"}
    done = spark.createDataFrame([("SRC.A", dt.datetime(2024, 1, 19, 23, 0), "SUCCESS",
                                   dt.datetime(2024, 1, 20, 1, 30), 30.0, 100, "")],
                                 "source_table string, event_time timestamp_ntz, status string, "
                                 "finish_time timestamp_ntz, duration_min double, num_records bigint, error string")
    queue, history = cycle.complete(queue, history, done)
    assert {r.source_table for r in queue.collect()} == {"SRC.B", "SRC.C"}
    h = {r.source_table: r.status for r in history.collect()}
    assert h == {"SRC.A": "SUCCESS", "SRC.B": "RUNNING"}
    read_to = dt.datetime(2024, 1, 19, 23, 30)  # SRC.A is done; its 23:30 event is in neither table
    assert cycle.resume_mark(queue, history, start="2024-01-01 00:00:00", last=read_to) == read_to
