"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from rowtide.plans.queries import QUERIES
from rowtide.session import tune

HEADLINE = [
    "load_csv",
    "load_tbl",
    "decode_roundtrip_orders",
    "decode_ints",
    "decode_floats",
    "decode_strings",
    "decode_decimals",
    "extract_images",
    "cdc_append",
    "cdc_upsert",
    "cdc_delete",
    "cdc_delete_composite",
    "dedupe_last_wins",
    "cdc_apply_ordered",
    "cdc_apply_grouped",
    "topk_fresh",
    "scan_filter",
    "pk_dup_audit",
    "freshness_groups",
    "table_version",
    "ensure_key_layout",
    "stream_apply",
]


def _heap_pools(spark: SparkSession) -> list:
    management = spark._jvm.java.lang.management
    pools = management.ManagementFactory.getMemoryPoolMXBeans()
    return [p for p in pools if p.getType().toString() == "Heap memory"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowtide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds, heap_mb = {}, {}
    for name in HEADLINE:
        for pool in _heap_pools(spark):
            pool.resetPeakUsage()
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        heap_mb[name] = sum(p.getPeakUsage().getUsed() for p in _heap_pools(spark)) >> 20
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "rowtide_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "peak_heap_mb": heap_mb,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
