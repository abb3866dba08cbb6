"""Ranking and claim queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import ranking
from tidemark.plans import oracle as O
from tidemark.plans.fixtures import RANK_AS_OF, SLOTS, Fixtures
from tidemark.plans.registry import register
from tidemark.sinks import tables


def claims(fx: Fixtures, materialize: bool = False) -> DataFrame:
    """This cycle's claims; ``materialize`` writes them with their ranks (at most the slot total
    of rows), for consumers that read them several times (see ``cycle.dispatch``)."""
    c = ranking.claim_eligible(fx.queue, fx.attrs, RANK_AS_OF, SLOTS)
    return tables.materialize(c, "claims") if materialize else c


@register("priority_rank", O.with_views("SELECT * FROM ranked", "ranked"))
def q_priority_rank(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return ranking.priority_rank(fx.queue, fx.attrs, RANK_AS_OF)


@register("staleness_tiers", O.with_views(f"""
SELECT {O.TIER_SQL} AS tier, count(*) AS rows
FROM (SELECT q.event_time, d.min_staleness, d.max_staleness, {O.staleness_sql(RANK_AS_OF)} AS staleness_m
      FROM queue q JOIN attrs d ON q.source_table = d.source_table WHERE q.status = 'Q') s
GROUP BY 1""", "queue", "attrs"))
def q_staleness_tiers(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return ranking.staleness_tiers(fx.queue, fx.attrs, RANK_AS_OF)


@register("fifo_rank", O.with_views("""
SELECT source_table, target_table, where_clause, primary_key, event_time, strategy, lock_rows, 1 AS priority,
  (SELECT count(*) FROM queue q2 WHERE q2.status = 'Q'
     AND (q2.event_time < q.event_time OR (q2.event_time = q.event_time AND q2.source_table <= q.source_table))) AS rank
FROM queue q WHERE status = 'Q'""", "queue"))
def q_fifo_rank(spark, sf_dir):
    return ranking.fifo_rank(Fixtures(spark, sf_dir).queue)


@register("claim_next", O.with_views("""
SELECT * FROM ranked WHERE rank IN (SELECT min(rank) FROM ranked WHERE rank >= 1 GROUP BY strategy)""", "ranked"))
def q_claim_next(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return ranking.next_eligible(fx.queue, fx.attrs, RANK_AS_OF)


@register("claim_slots", O.with_views("SELECT * FROM claims", "claims"))
def q_claim_slots(spark, sf_dir):
    return claims(Fixtures(spark, sf_dir))
