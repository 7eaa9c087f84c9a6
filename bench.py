"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], forcing full evaluation with the ``noop`` sink, and
prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each figure is the median of 3 timed runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "records_to_process",     # flagship: fill/filter, anti-join, clean, filter
    "clean_description",      # five-step cleaning over every document
    "validate_docs",          # strict JSON + typed classification
    "duplicate_content",      # content-hash groups over documents
    "repair_record",          # value normalisation
    "merge_docs",             # three-way keyed merge (one shuffle)
    "impact_mismatch",        # set comparison after merge
    "publish_action",         # hash-compared publish plan
    "attempt_ladder_live",    # inference job with stub client (writes attempts)
    "concat_chunks",          # ordered chunk concatenation
    "incremental_stream",     # two availableNow runs
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    from skein.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="skein-bench", shuffle_partitions=int(cpus) * 2,
                      driver_memory=os.environ.get("BENCH_MEM", "8g"))
    from skein.operators.layout import SCAN_PARTITIONS
    from skein.plans.catalog import QUERIES
    # the bench tables are single row groups, which a scan can't split
    spark.conf.set(SCAN_PARTITIONS, cpus)
    times = {}
    for n in names:
        def once():
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        once()  # warm-up: JIT, file listing, Python workers
        times[n] = round(statistics.median(once() for _ in range(runs)), 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
