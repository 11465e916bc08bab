"""Time the headline queries at one scale and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogproof.queries import QUERIES  # noqa: E402

HEADLINE = [
    "audit_report",
    "missing_pages",
    "short_pages",
    "redo_chunks",
    "merge_chunks",
    "content_duplicates",
    "canonical_category",
    "clean_records",
    "conservation_check",
    "import_review",
    "lookup_first",
    "splice_recovered",
    "reconcile",
    "stale_outputs",
    "lot_status",
    "stratified_sample",
    "size_stats",
    "clean_text",
    "slug",
    "strip_boilerplate",
    "sectionize",
    "to_markdown",
    "explode_panels",
    "harvest_panels",
    "payload_fields",
    "failure_streaks_run",
    "read_chunks",
    "ingest_incremental",
    "throughput_windows",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("catalogproof-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    chosen = sys.argv[1:]
    main(list(QUERIES) if chosen == ["all"] else chosen or HEADLINE)
