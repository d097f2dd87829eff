"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once to warm the JVM and then timed; its result goes to Spark's ``noop`` sink, which computes every
column of every row and stores nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workloads import QUERIES  # noqa: E402

HEADLINE = (
    "posts_per_cause", "clean_text", "spam_flag", "payload_fields", "author_backfill", "dedup_best", "landing_merge",
    "normalize_labels", "validate_split", "cache_hit", "annotate", "explode_causes", "entity_exact", "entity_fuzzy",
    "entity_mentions", "upsert_star", "store_reload", "q_causes", "q_complaints", "q_product_barrier", "q_cause_sentiment",
    "q_cause_avg", "q_entity_cause", "rising", "spike", "embed_default", "search_topk", "clusters", "export_roundtrip",
    "ingest_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # The tables are single files: split them over the cores.
        .config("spark.sql.files.maxPartitionBytes", "1m")
        .config("spark.sql.files.minPartitionNum", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
