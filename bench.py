"""Benchmark: time the headline queries on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed to completion with the ``noop`` sink (full plan, no
driver collection): one warm-up run, then the median of ``BENCH_RUNS`` timed
runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import all_plans  # noqa: E402
from tessera.session import build_session  # noqa: E402

# One or more queries per operator family.
HEADLINE = [
    "rating_stats", "segment_means", "lineitem_correlations", "price_summary", "portfolio_value",
    "order_uncertain_totals", "document_word_count", "document_clean_word_count", "word_document_frequency",
    "document_concordance", "customer_max_concurrency", "user_event_rle", "order_price_positions",
    "brand_wheel_lookup", "part_size_three_sum", "supplier_slot_bag_difference", "supplier_enrichment",
    "page_links", "page_crawl", "tree_nested_sets", "user_portfolio_fold", "order_date_formats",
    "part_rating_ok", "line_positions_ok", "customer_postcodes", "conversation_chain_positions",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    plans = all_plans()
    names = only or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        fn = plans[name].fn
        run(fn(spark, sf_dir))  # warm-up (JIT, file listing, Python workers)
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            run(fn(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "spark": spark.version}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
