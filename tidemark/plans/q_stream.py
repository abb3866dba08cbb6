"""Streaming queries: the cycle's feed arrives as 4 time slices, one micro-batch each.

After every slice the stream is started again from its checkpoint with
``availableNow`` (a restart per slice), so the result also shows that
progress survives restarts. Each result must equal the batch operator's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.timeexpr import ntz
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import CATALOG, Fixtures
from tidemark.plans.registry import register
from tidemark.schemas import FEED
from tidemark.session import work_path
from tidemark.sinks.tables import materialize
from tidemark.streaming.enqueue import feed_slices, read_version, start_coalesce, start_enqueue
from tidemark.streaming.quiet import read_bursts, start_bursts

SLICES = 4


@register("stream_enqueue", O.with_views("SELECT * FROM upserted", "upserted"))
def q_stream_enqueue(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    base = work_path(spark, "stream_enqueue")
    feed_dir, queue_root, ckpt = f"{base}/feed", f"{base}/queue", f"{base}/checkpoint"
    for part in feed_slices(fx.incoming.select("source_table", "event_time"), SLICES):
        part.write.mode("append").parquet(feed_dir)
        start_enqueue(spark, feed_dir, FEED, fx.attrs, CATALOG, queue_root, ckpt,
                      initial_queue=fx.queue).awaitTermination()
    return read_version(spark, queue_root)


@register("stream_coalesce", O.with_views("""
SELECT source_table, min(event_time) AS first_event_time, max(event_time) AS latest_event_time, count(*) AS events
FROM incoming GROUP BY source_table""", "incoming"))
def q_stream_coalesce(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    base = work_path(spark, "stream_coalesce")
    feed_dir, root, ckpt = f"{base}/feed", f"{base}/state", f"{base}/checkpoint"
    for part in feed_slices(fx.incoming.select("source_table", "event_time"), SLICES):
        part.write.mode("append").parquet(feed_dir)
        start_coalesce(spark, feed_dir, FEED, root, ckpt).awaitTermination()
    return read_version(spark, root)


# Bursts end after a day without events; the watermark is two days behind the latest event.
QUIET_DAYS, DELAY_DAYS = 1, 2


@register("stream_bursts", O.with_views(f"""
SELECT source_table, min(event_time) AS first_event_time, max(event_time) AS latest_event_time, count(*) AS events
FROM (SELECT *, sum(opens) OVER (PARTITION BY source_table ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS burst
      FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY source_table ORDER BY event_time)
                                <= INTERVAL {QUIET_DAYS} DAY THEN 0 ELSE 1 END AS opens FROM counted) a) b
GROUP BY source_table, burst
HAVING max(event_time) + INTERVAL {QUIET_DAYS} DAY < (SELECT max(event_time) FROM feed) - INTERVAL {DELAY_DAYS} DAY""",
                                        "feed", extra={
    "sliced": """SELECT feed.*, CASE WHEN event_time < TIMESTAMP '2024-01-10 00:00:00' THEN 0
  WHEN event_time < TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 2 END AS slice, event_id % 10 = 0 AS held FROM feed""",
    "counted": f"""SELECT source_table, event_time FROM sliced s
WHERE NOT held OR slice = 2 OR event_time > (SELECT max(event_time) FROM sliced x
  WHERE x.slice <= s.slice AND (x.slice < s.slice OR NOT x.held)) - INTERVAL {DELAY_DAYS} DAY"""}))
def q_stream_bursts(spark, sf_dir):
    """Bursts of events per table, closed by timers; the feed comes in three slices, every tenth row a slice late:
    out of order, and dropped where the watermark has passed it."""
    fx = Fixtures(spark, sf_dir)
    base = work_path(spark, "stream_bursts")
    feed_dir, root, ckpt = f"{base}/feed", f"{base}/bursts", f"{base}/checkpoint"
    t = F.col("event_time")
    number = F.when(t < ntz("2024-01-10 00:00:00"), 0).when(t < ntz("2024-01-20 00:00:00"), 1).otherwise(2)
    late = F.least(number + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0), F.lit(2))
    rows = materialize(fx.feed.select("source_table", "event_time", late.alias("arrives")), "feed")
    for i in range(3):
        rows.where(F.col("arrives") == i).select("source_table", "event_time").write.mode("append").parquet(feed_dir)
        start_bursts(spark, feed_dir, FEED, root, ckpt, quiet=dt.timedelta(days=QUIET_DAYS),
                     delay=f"{DELAY_DAYS} days").awaitTermination()
    return read_bursts(spark, root)
