"""Staleness minutes and the staleness-tier weight of a queued table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.timeexpr import seconds_between

# Slack thresholds (max_staleness - staleness, minutes) and their
# weights, checked top to bottom with a strict ">"; below all of them the weight
# is 25. A table fresher than its min_staleness gets weight 0 (hidden).
TIER_STEPS = [
    (60, 1), (45, 2), (30, 3), (15, 4), (10, 5), (5, 6), (3, 7), (2, 8), (1, 9),
    (0, 10), (-5, 15), (-10, 20),
]
TIER_FLOOR = 25
TIER_HIDDEN = 0


def staleness_minutes(event_time: Column, as_of: Column) -> Column:
    """Whole minutes from ``event_time`` to ``as_of`` (floor), as bigint.

    Both ends are truncated to seconds first: the reference keeps whole seconds,
    and an untruncated difference can move the floor by a minute.
    """
    secs = seconds_between(event_time, as_of)
    return F.floor(secs / F.lit(60)).cast("bigint")


def staleness_tier(staleness_m: Column, min_staleness: Column, max_staleness: Column) -> Column:
    """Tier weight (int). Null max falls to the floor weight; null min never hides."""
    slack = max_staleness - staleness_m
    first = F.when(staleness_m < min_staleness, F.lit(TIER_HIDDEN))
    chain = reduce(lambda acc, step: acc.when(slack > F.lit(step[0]), F.lit(step[1])), TIER_STEPS, first)
    return chain.otherwise(F.lit(TIER_FLOOR)).cast("int")


def weighted_priority(tier: Column, base_priority: Column) -> Column:
    return (tier * base_priority).cast("int")


def next_step(staleness_m: Column, min_staleness: Column, max_staleness: Column) -> Column:
    """The next whole minute of staleness at which the tier may change (null: it stays for good).

    That is where the table stops being hidden, or where its slack no longer
    passes the highest limit that it passes now.
    """
    ends = [max_staleness - F.lit(limit) for limit, _ in TIER_STEPS]
    after = F.least(*[F.when(e > staleness_m, e) for e in ends], F.lit(None).cast("long"))
    return F.when(staleness_m < min_staleness, min_staleness.cast("long")).otherwise(after.cast("long"))
