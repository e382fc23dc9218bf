"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from murmur.session import get_spark  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "component_counts", "pii_scrub", "spam_flags", "clean_pipeline", "dedup_exact", "normalize_union",
    "preprocess", "sentiment_label", "phrase_chunks", "term_freq", "top_terms", "surface_mode", "find_words",
    "categorize", "key_issues", "tfidf", "clusters", "group_summary", "incremental_filter", "forward_fill",
    "generic_component_drop", "order_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("murmur-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false", "spark.murmur.readPartitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
