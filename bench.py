"""Bench: run the headline queries at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS]; print one JSON line.

Each query is planned and fully computed (written to Spark's no-op sink,
so every row is produced but none is shipped to Python) and timed; the value
is the sum of the query times. Row counts are taken afterwards, untimed.
Before timing, three small queries warm the JVM and the Python workers.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "full_run_summary",     # J1 on listings from documents: F1, T1, D3-D5, G1
    "full_run_pages",       # J1 end to end: pages -> E* -> F1 -> T1 -> D3-D5 -> G1
    "dedup_ordered",        # D5 alone over every document
    "organize_only",        # J2: discards to Trash, re-bucketing
    "ledger_prepend",       # L7, L8, L5 after a run
    "migrate_rows",         # L10 over the raw ledger
    "known_urls",           # D1 over every cell
    "unify_listings",       # E4-E14 over rendered card pages
    "page_markdown",        # E1-E3 over every page
    "derive_title",         # R4 over every URL
    "polish_filter",        # F1
    "topn_per_url",         # T1
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from listledger.session import local_session
    from listledger.plans.queries import QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    names = sys.argv[1:] or HEADLINE
    # warm the JVM, code generation and the Python workers once, on the
    # smallest tables when they are there (not timed)
    warm_dir = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for q in ("polish_filter", "page_markdown", "html_cards_attr"):
        QUERIES[q](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, rows = {}, {}
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        # compute every row of the result without shipping it to Python
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        rows[name] = df.count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "sf": float(m.group(1)) if m else None, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
