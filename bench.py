"""Headline queries, timed end to end. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from fiscalmill.plans.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "xml_scan_items",
    "tag_unify",
    "role_resolution",
    "item_tax_base",
    "items_union",
    "item_sums",
    "control_number",
    "header_table",
    "new_partners_table",
    "run_metrics",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("fiscalmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["doc_number"](spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
