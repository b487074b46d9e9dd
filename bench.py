"""Time the headline queries; prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeops.plans import QUERIES
from lakeops.session import build_session, drop_scratch

HEADLINE = (
    "product_sales_daily", "order_summary", "net_sales_reconciliation", "best_day_per_store", "gross_by_product",
    "asof_version_join", "scd2_customers", "bought_with_edges", "two_hop_recommendations", "referral_tree",
    "similarity_join_customers", "dedupe_exact", "quarantine_lines", "cdc_all_changes", "place_orders_lines",
    "chunk_profile", "refresh_chunks", "knn_exact", "ann_search", "bm25_rank", "hybrid_rrf", "stream_order_upsert",
)


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    drop_scratch(spark)
    return took


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session("bench", cores, partitions=2 * int(cores) if cores.isdigit() else 16)
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm up the JVM
    seconds = {name: round(statistics.median(run(spark, name, folder) for _ in range(repeats)), 3) for name in names}
    print(json.dumps({
        "metric": "total seconds of headline queries (median of runs)", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"), "cores": cores, "repeats": repeats}))


if __name__ == "__main__":
    main()
