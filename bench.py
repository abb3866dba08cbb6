"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (nothing is collected
to the driver). One warm-up pass, then ``BENCH_REPEAT`` timed passes; the best
time per query is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["priority_rank", "queue_upsert", "load_merge_pk", "load_replace_where", "cdc_plan",
            "claim_slots", "history_after_claim", "enqueue_records", "load_report", "row_count_reconcile"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from tidemark.plans.registry import queries
    from tidemark.session import local_session

    spark = local_session(cpus, app="tidemark-bench")
    qs = queries()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, file listing caches, Python imports
        run(n)
    best = {n: min(run(n) for _ in range(repeat)) for n in names}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(best.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in best.items()}, "sf": float(sf) if sf else sf_dir,
        "cpus": int(cpus) if cpus.isdigit() else cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
