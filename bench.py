"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Step 1 (timed as ``build_silver``) derives the sold / listed / rate tables
from the driver's parquet tables and writes them as Parquet under the shared
folder — the hand-over table between pipeline stages. Each headline query
then runs from those tables with a fresh plan and is executed in full
(``noop`` sink, no driver collect). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_counties_by_price",
    "numeric_distribution",
    "numeric_stats",
    "compact_stats",
    "null_profile",
    "validate_sold",
    "validate_listed",
    "price_vs_list",
    "dom_summary",
    "monthly_counts",
    "duplicate_keys",
    "rates_monthly",
    "enrich_sold",
    "join_audit",
    "unmatched_months",
    "histogram_original_list_price",
    "boxplot_stats",
    "dropped_columns",
    "clean_sold",
    "clean_listed",
    "flag_log",
    "scorecard",
    "geo_validity",
    "features_price",
]

# These write the CSV exports they read, so their time is mostly the writing; outside the total.
FILE_SIDE = ["file_overview", "header_consistency", "read_table", "per_file_profile"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("homestats-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # per-Column call-site capture costs several JVM round trips per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from homestats.session import ensure_checkpoint_dir, release_scratch, scratch_path

    ensure_checkpoint_dir(spark)  # the session's spark.checkpoint.dir; a local temp folder only if unset
    silver_root = scratch_path(spark, "silver")  # shared folder, not a machine-local temp dir
    from homestats.plans import filequeries  # noqa: F401  (registers the file-side queries)
    from homestats.plans.catalog import BODIES, as_text_dates
    from homestats.plans.relations import Relations
    from homestats.sources.testrel import relation

    times: dict[str, float] = {}
    relation(spark, sf_dir, "rates").collect()  # warm-up: JVM, codegen, scan path (not timed)
    t0 = time.perf_counter()
    silver = {}
    for name in ("sold", "listed", "rates"):
        path = f"{silver_root}/{name}"
        w = relation(spark, sf_dir, name).write.mode("overwrite")
        if name != "rates":
            w = w.partitionBy("PropertyType")  # the Residential filter then prunes files
        w.parquet(path)
        silver[name] = path
    times["build_silver"] = time.perf_counter() - t0

    def rel() -> Relations:
        return Relations.from_tables(spark, *(spark.read.parquet(silver[n]) for n in ("sold", "listed", "rates")))

    def run(name: str) -> None:
        as_text_dates(BODIES[name](rel())).write.format("noop").mode("overwrite").save()

    run("price_vs_list")  # warm-up on the silver tables (not timed)
    for name in HEADLINE:
        t = time.perf_counter()
        run(name)
        times[name] = time.perf_counter() - t

    total = sum(times.values())
    for name in FILE_SIDE:
        t = time.perf_counter()
        run(name)
        times[name] = time.perf_counter() - t
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
    }))
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
