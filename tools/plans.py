"""Print the executed (final adaptive) physical plans of the headline queries.

    python tools/plans.py [sf_dir] > PLANS.md.body

Each query is run with ``collect()`` on its own DataFrame so that ``explain``
shows the final AQE plan (broadcast conversions, coalesced reads, reused
exchanges) rather than the initial one.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["priority_rank", "claim_slots", "queue_upsert", "history_after_claim", "cdc_plan", "load_merge_pk",
            "load_replace_where", "enqueue_records", "row_count_reconcile"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tidemark.plans.registry import queries
    from tidemark.session import local_session

    from tidemark.operators import loading
    from tidemark.plans.fixtures import Fixtures

    spark = local_session(8)
    qs = queries()
    fx = Fixtures(spark, sf_dir)
    # The load keys return the table read back; show the rewrite that gets written instead.
    rewrites = {
        "load_merge_pk": lambda: loading.merge_pk(fx.load_target, fx.load_source, "o_orderkey"),
        "load_replace_where": lambda: loading.replace_where(fx.load_target, fx.load_source,
                                                            "o_orderdate >= '1998-01-01'"),
    }
    for name in HEADLINE:
        df = rewrites[name]() if name in rewrites else qs[name](spark, sf_dir)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("simple")
        text = buf.getvalue()
        text = re.sub(r"#\d+L?", "", text)
        text = re.sub(r"file:[^\],]+", "<path>", text)
        text = text.split("+- == Initial Plan ==")[0]
        tree = [ln for ln in text.splitlines() if ln.strip() and not ln.startswith("==")]
        print(f"### {name}\n\n```\n" + "\n".join(ln[:160] for ln in tree) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
