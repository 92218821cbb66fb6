"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_RUNS`` (default 3).
Each query runs once to warm up; its time is the median of the runs after that.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickweave.plans.catalog import BUILDERS
from clickweave.session import local_session

HEADLINE = [
    "area_top3_product", "session_rollup", "session_stats", "session_extract", "top10_category", "top10_session",
    "page_convert_rate", "category_counts", "wordcount_clean", "inverted_index_links", "tfidf_sql", "bloom_filter_docs",
    "sum_by_key", "agg_salted", "daily_uv", "top3_per_category", "row_number_rank", "total_order_sort", "join_inner",
    "join_full", "join_skew_split", "join_salted", "join_bucketed", "hierarchy_order_lines",
    "group_values", "posts_vs_average", "src_xml_rows", "sink_upsert_add", "st_running_count", "st_user_ad_counts",
]


def run(spark, folder: str, key: str) -> float:
    start = time.perf_counter()
    BUILDERS[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    seconds = {}
    for key in chosen:
        run(spark, folder, key)
        seconds[key] = round(statistics.median(run(spark, folder, key) for _ in range(runs)), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
