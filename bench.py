"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is executed in full with a ``noop`` write (no collection to the
driver). Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from itemscope.plans.queries import QUERIES  # noqa: E402
from itemscope.session import build_session  # noqa: E402

HEADLINE = [
    "clean_catalog", "clean_interactions", "clean_tags", "rating_features", "rating_features_script",
    "tag_features", "feature_frame", "quality_checks", "missing_profile", "join_coverage", "scale_metrics",
    "top_categories_raw", "processed_dictionary", "model_matrix", "standardized_matrix", "pca_summary",
    "pca_target_variance", "tfidf_long", "svd_variance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8), app_name="itemscope-bench")
    # warm-up (JIT, codegen caches); not timed
    QUERIES["scale_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
