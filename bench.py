"""Seconds per headline query: ``BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py``.

Each query is written to a sink that discards the rows, so every column of every row is computed and nothing is
sent to the driver. A query is run twice and the faster run counts; the first one includes compiling its code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from loadlake.plans.workload import QUERIES, configured
from loadlake.session import session

HEADLINE = (
    "silver_readings",
    "latest_readings",
    "hourly_load",
    "system_hourly",
    "profile_24h",
    "profile_all_grains",
    "local_calendar",
    "curve_stats",
    "normalized_curve",
    "price_quantiles",
    "load_metrics",
    "calibrated_curve",
    "quality_report",
    "coverage_regression",
    "row_count_anomaly",
    "ledger_versions",
    "revisions",
    "revision_row_changes",
    "gated_ledger",
    "freshness",
    "preferred_resources",
    "period_from_name",
    "page_links",
    "scenario_table",
    "regional_allocation",
    "overlay_summary",
)


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session("bench", cores=int(os.environ.get("BENCH_CPUS", "8")))
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            configured(QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
