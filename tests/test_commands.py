"""The command stream: refused commands, restarts, marks, kept versions; bursts with timers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import queue as qops
from tidemark.schemas import ATTRS, FEED, HISTORY, QUEUE
from tidemark.streaming import commands, quiet
from tidemark.streaming.enqueue import published_versions

T0 = dt.datetime(2024, 1, 1, 6)


def attr(table, strategy="JDBC", priority=2, disabled=False):
    return (table, None, "cdc", None, "id", strategy, disabled, priority, 0, 30)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The rows here are a handful: one task a shuffle."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def folders(tmp_path):
    return commands.Folders(str(tmp_path / "state"))


def feed(spark, folders, *rows):
    spark.createDataFrame([(t, T0 + dt.timedelta(minutes=m)) for t, m in rows], FEED).write.mode("append").parquet(folders.feed)


def run(spark, folders, attrs, **options):
    given = attrs if callable(attrs) else lambda: spark.createDataFrame(attrs, ATTRS)
    empty = (spark.createDataFrame([], QUEUE), spark.createDataFrame([], HISTORY))
    commands.start_commands(spark, folders, given, "main", initial=empty, **options).awaitTermination()
    return commands.read_state(spark, folders)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_a_row_is_claimed_once(spark, folders):
    folders.create(spark)
    attrs = [attr("A.T1"), attr("A.T2")]
    feed(spark, folders, ("A.T1", 0), ("A.T2", 1), ("A.T3", 2))
    state = run(spark, folders, attrs)
    assert rows(state.queue, "source_table", "status") == [("A.T1", "Q"), ("A.T2", "Q")]
    typed = spark.createDataFrame(attrs, ATTRS)
    first = commands.issue_claims(spark, folders, typed, "2024-01-01 07:00:00", {"JDBC": 1})
    second = commands.issue_claims(spark, folders, typed, "2024-01-01 07:01:00", {"JDBC": 1})  # sees the same version
    state = run(spark, folders, attrs)
    assert rows(state.queue, "source_table", "status") == [("A.T1", "R"), ("A.T2", "Q")]
    assert commands.accepted_claims(state.queue, first).count() == 1
    assert commands.accepted_claims(state.queue, second).count() == 0
    assert rows(spark.read.parquet(folders.refused), "source_table", "reason") == [("A.T1", "row does not wait")]
    assert rows(state.history, "source_table", "status") == [("A.T1", "RUNNING")]
    assert qops.queue_key_check(state.queue).isEmpty()


def test_completions_twice_and_of_rows_that_do_not_run(spark, folders):
    folders.create(spark)
    attrs = [attr("A.T1"), attr("A.T2")]
    feed(spark, folders, ("A.T1", 0), ("A.T2", 1))
    run(spark, folders, attrs)
    commands.issue_claims(spark, folders, spark.createDataFrame(attrs, ATTRS), "2024-01-01 07:00:00", {"JDBC": 1})
    state = run(spark, folders, attrs)
    done = spark.createDataFrame([(t, e, "SUCCESS", T0, 1.5, 7, "") for t, e in rows(state.queue, "source_table", "event_time")],
                                 "source_table string, event_time timestamp_ntz, status string, finish_time timestamp_ntz, "
                                 "duration_min double, num_records long, error string")
    commands.issue_completions(spark, folders, done, "2024-01-01 08:00:00")
    commands.issue_completions(spark, folders, done, "2024-01-01 08:00:01")
    state = run(spark, folders, attrs)
    assert rows(state.queue, "source_table", "status") == [("A.T2", "Q")]
    assert rows(state.history, "source_table", "status", "num_records") == [("A.T1", "SUCCESS", 7)]
    assert rows(spark.read.parquet(folders.refused), "source_table", "reason") == [
        ("A.T1", "row does not run"), ("A.T2", "row does not run"), ("A.T2", "row does not run")]


def test_the_mark_stays_and_a_new_checkpoint_does_not_enqueue_again(spark, folders, tmp_path):
    folders.create(spark)
    attrs = [attr("A.T1")]
    feed(spark, folders, ("A.T1", 0), ("A.T1", 9))
    state = run(spark, folders, attrs)
    assert state.mark == T0 + dt.timedelta(minutes=9)
    commands.issue_claims(spark, folders, spark.createDataFrame(attrs, ATTRS), "2024-01-01 07:00:00", {"JDBC": 1})
    state = run(spark, folders, attrs)
    done = state.queue.select("source_table", "event_time", F.lit("SUCCESS").alias("status"), F.lit(T0).cast("timestamp_ntz").alias("finish_time"),
                              F.lit(1.0).alias("duration_min"), F.lit(1).alias("num_records"), F.lit("").alias("error"))
    commands.issue_completions(spark, folders, done, "2024-01-01 08:00:00")
    state = run(spark, folders, attrs)
    assert state.queue.isEmpty() and state.mark == T0 + dt.timedelta(minutes=9)
    state = run(spark, folders, attrs, checkpoint=str(tmp_path / "other"))
    assert state.queue.isEmpty() and rows(state.history, "source_table", "status") == [("A.T1", "SUCCESS")]
    feed(spark, folders, ("A.T1", 5))  # a late row of a new file is not lost
    state = run(spark, folders, attrs, checkpoint=str(tmp_path / "other"))
    assert rows(state.queue, "source_table", "status") == [("A.T1", "Q")] and state.mark == T0 + dt.timedelta(minutes=9)


def test_attributes_are_read_for_every_batch_and_checked(spark, folders):
    folders.create(spark)
    now = [[attr("A.T1")]]
    given = lambda: spark.createDataFrame(now[0], ATTRS)
    feed(spark, folders, ("A.T1", 0), ("A.T2", 0))
    assert rows(run(spark, folders, given).queue, "source_table") == [("A.T1",)]
    now[0] = [attr("A.T1", disabled=True), attr("A.T2"), attr("A.T3"), attr("A.T3", priority=5), attr("A.T4", strategy="FTP")]
    feed(spark, folders, ("A.T1", 1), ("A.T2", 1), ("A.T3", 1), ("A.T4", 1))
    assert rows(run(spark, folders, given).queue, "source_table") == [("A.T1",), ("A.T2",)]


def test_replayed_rows_and_old_versions(spark, folders):
    folders.create(spark)
    attrs = [attr("A.T1"), attr("A.T2")]
    for _ in range(2):
        feed(spark, folders, ("A.T1", 0), ("A.T2", 300))
        state = run(spark, folders, attrs, delay="1 hour", keep_versions=2)
    assert rows(state.queue, "source_table", "event_time_latest") == [("A.T1", None), ("A.T2", None)]  # each event once
    late = commands.read_late(spark, folders)
    assert rows(late, "source_table", "event_time") == [("A.T1", T0)]
    assert len(published_versions(spark, folders.queue)) == 2


def test_bursts_join_and_close(spark, tmp_path):
    rng = random.Random(3)
    for _ in range(200):
        events = [rng.randrange(300) for _ in range(rng.randrange(1, 30))]
        got: list = []
        for i in range(0, len(events), 4):  # in any order, some at a time
            got = quiet.join_bursts(got, events[i:i + 4], 9)
        want: list = []
        for t in sorted(events):
            if want and t - want[-1][1] <= 9:
                want[-1] = (want[-1][0], t, want[-1][2] + 1)
            else:
                want.append((t, t, 1))
        assert got == want


def test_state_of_a_quiet_table_goes(spark, tmp_path):
    path, root, ckpt = (str(tmp_path / n) for n in ("feed", "bursts", "checkpoint"))

    def step(*given):
        spark.createDataFrame([(t, T0 + dt.timedelta(minutes=m)) for t, m in given], FEED).write.mode("append").parquet(path)
        q = quiet.start_bursts(spark, path, FEED, root, ckpt, quiet=dt.timedelta(minutes=10), delay="5 minutes")
        q.awaitTermination()
        return quiet.state_rows(q)

    many = step(*[(f"T{i}", i % 3) for i in range(20)], ("T0", 8))
    assert quiet.read_bursts(spark, root).isEmpty() and many >= 20
    left = step(("T99", 60))  # the watermark passes all others
    got = quiet.read_bursts(spark, root)
    assert got.count() == 20 and got.where("source_table = 'T0'").first().events == 2 and left < many
    assert step(("T1", 3)) <= left  # too late: dropped, opens nothing
    assert quiet.read_bursts(spark, root).count() == 20
