"""One sync cycle as DataFrame steps: enqueue the feed, rank, claim, apply, complete.

This is what the reference's poll loops do table by table; here each step is
one distributed plan over all tables. The caller publishes the returned
states (``sinks.tables.publish`` or the streaming ``foreachBatch``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators import feed as feedops
from tidemark.operators import queue as qops
from tidemark.operators import ranking
from tidemark.operators.marks import TableSpec, plan_tables
from tidemark.schemas import DEFAULT_CUTOFF
from tidemark.sinks.tables import materialize
from tidemark.sources.feed import incremental_scan

Locate = Callable[[str, str], tuple[str, str]]  # (source_table, target_table) -> paths of both


@dataclass
class Dispatch:
    claims: DataFrame
    queue: DataFrame
    history: DataFrame


def resume_mark(queue: DataFrame, history: DataFrame, start, last=None):
    """The feed mark to resume from: one aggregated value (latest known event in queue or
    history), else ``start``; never before ``last``, the mark that the last cycle read to
    (a completed table's later events are in neither table)."""
    mark = qops.resume_watermark(queue, history, start=start).first()["watermark"]
    return mark if last is None or (mark is not None and mark > last) else last


def enqueue(queue: DataFrame, tracking: DataFrame, attrs: DataFrame, catalog: str, watermark, as_of,
            plan: DataFrame | None = None, locate: Locate | None = None, cutoff: int = DEFAULT_CUTOFF,
            **scan_options) -> DataFrame:
    """Read the feed range (watermark, as_of], coalesce per table, enrich and MERGE into the queue.

    ``locate(source_table, target_table)`` gives the stored paths of a table's
    source and target; with it the feed's tables that have a change column are
    planned one by one before they are queued. Attributes are checked on the way
    (``feed.enqueue_rejects`` lists what is left out).
    """
    feed = incremental_scan(tracking, watermark, as_of, **scan_options)
    if locate is not None:
        plan = plan_feed(feed, attrs, locate, cutoff)
    return qops.queue_upsert(queue, feedops.enqueue_from_feed(feed, attrs, catalog, plan))


def plan_feed(feed: DataFrame, attrs: DataFrame, locate: Locate, cutoff: int = DEFAULT_CUTOFF) -> DataFrame:
    """Load plans of the feed's tables with valid attributes (a row per table that changed since the last poll)."""
    rows = (feedops.lookup_attrs(attrs).where("valid").join(feedops.table_names(feed), "source_table", "left_semi")
            .select("source_table", "target_table", "cdc_watermark", "strategy").orderBy("source_table").collect())
    specs = [TableSpec(r["source_table"], *locate(r["source_table"], r["target_table"]), r["cdc_watermark"] or None,
                       r["strategy"]) for r in rows]
    return plan_tables(feed.sparkSession, specs, cutoff)


def dispatch(queue: DataFrame, history: DataFrame, attrs: DataFrame, as_of, slots: Mapping[str, int],
             view: ranking.RankView = ranking.priority_rank) -> Dispatch:
    """Rank the queue, claim the free slots and apply the claims to queue and history.

    The claims are written once (at most the slot total of rows) so both
    transitions apply the same decision. The default ranking never ranks the
    whole queue; a view of the user's own is applied to all of it.
    """
    if view is ranking.priority_rank:
        best = ranking.claim_eligible(queue, attrs, as_of, slots)
    else:
        best = ranking.claim_slots(ranking.rank_queue(queue, attrs, as_of, view), slots)
    claims = materialize(best, "claims")
    return Dispatch(claims, qops.queue_after_claim(queue, claims, as_of),
                    qops.history_after_claim(history, claims, as_of))


def complete(queue: DataFrame, history: DataFrame, completions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove finished running rows from the queue and record their outcome in history."""
    return qops.queue_after_complete(queue, completions), qops.history_after_complete(history, completions)
