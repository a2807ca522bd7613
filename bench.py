"""Time the headline queries: one JSON line. BENCH_SF_DIR names the data, BENCH_CPUS the local cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumbline.session import builder  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "clean_orders",
    "fact_sales_order",
    "star_orders",
    "daily_sales_kpi",
    "monthly_sales_trend",
    "segment_kpi",
    "cohort_month",
    "recon_daily",
    "recon_close",
    "check_suite",
    "enterprise_summary",
    "foreign_key_orphans",
    "column_profile_orders",
    "column_profile_documents",
    "rule_results",
    "order_distribution",
    "histogram",
    "correlation",
    "score_dimensions",
    "score_recurrence",
    "score_timeliness",
    "score_coverage",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
