"""Benchmark: headline queries on $BENCH_SF_DIR, local[$BENCH_CPUS], warm session, median of 3.

Prints one JSON line:
{"metric": "headline_total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed fully with the ``noop`` sink (no driver collect), so
the time is the plan's own execution time.  Jobs with side effects (the
governed load, the partitioned ETL write) are timed end to end.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cauce.plans.registry import all_queries  # noqa: E402
from cauce.session import get_session  # noqa: E402

HEADLINE = [
    "g02_three_key_groupby",        # baseline A shape: 3-key group-by with conditional sum and ratio
    "z06_spark_etl_summary",        # baseline B shape: read, validate, join, aggregate, partitioned write
    "g03_revenue_by_category",      # Q1
    "g04_rate_above_overall",       # Q2
    "w01_monthly_change",           # Q3
    "g20_top_customers",            # Q4
    "g21_reasons_by_month",         # Q5
    "v03_order_contract",           # contract validation with FK
    "z01_governed_etl",             # governed incremental load
    "w02_dedupe_exact_then_near",
    "t10_tfidf",
    "t13_lexical_search",
    "j13_window_pairs",
    "m20_roc_points",
]


def run_once(spark, fn, sf):
    t0 = time.perf_counter()
    df = fn(spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = get_session(f"local[{cpus}]", app="cauce-bench", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "16g"})
    qs = all_queries()
    # warm-up: JVM, Python workers and file listing, as in the reference's warm-session runs
    run_once(spark, qs["g03_revenue_by_category"], sf)
    out = {}
    for n in names:
        times = [run_once(spark, qs[n], sf) for _ in range(reps)]
        out[n] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(m.group(1)) if m else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
