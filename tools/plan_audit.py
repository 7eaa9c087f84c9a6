"""Flag registered queries whose optimized plan repeats expensive
expressions (a sign that a filter or projection inlined a parse/regex)."""

import re
import sys

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__file__)))

from skein.plans.catalog import QUERIES  # noqa: E402
from skein.session import get_spark  # noqa: E402

SKIP = {"read_csv_records", "publish_layout", "incremental_stream", "infer_stub", "attempt_ladder_live",
        "enhance_gate", "best_of", "infer_run_stats", "reprocess_insufficient", "reprocess_stats",
        "upsert_if_better"}


def main():
    spark = get_spark("local[4]", shuffle_partitions=4)
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    for n, q in QUERIES.items():
        if n in SKIP and "--all" not in sys.argv:
            continue
        plan = q(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        counts = {k: len(re.findall(k, plan)) for k in ("from_json\\(", "regexp_replace\\(", "regexp_extract\\(")}
        print(n, len(plan), counts, flush=True)


if __name__ == "__main__":
    main()
