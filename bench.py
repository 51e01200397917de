"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query is built and run in full, to a sink that discards the rows.  Queries
named on the command line replace the headline ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from shelfline.plans import catalog

HEADLINE = [
    "etl_dedup_latest", "etl_enriched", "clean_full", "features_dashboard", "sql_demand_features", "mart_daily_store",
    "mart_category", "mart_regional", "mart_stockout", "mart_promo", "category_summary", "allocate_inventory",
    "anomaly_summary", "reorder_point", "stockout_topk", "segment_stats", "percentile_lookup", "bundle_pairs",
    "reorder_schedule", "forecast_score", "request_validation", "stream_daily_mart",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # start the executor threads and the code generator before the first query is timed
    catalog.QUERIES["duplicate_keys"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
