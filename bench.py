"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores.

Every query is run twice; ``queries`` has the second run, ``first_run`` the first. A time covers building the
plan, planning and execution of the whole result, from the driver's Parquet files on.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lodeworks.session import local_session  # noqa: E402
from verify.registry import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "shift_kpis",
    "equipment_performance",
    "ml_failure_features",
    "ml_process_features",
    "px_daily_summary",
    "px_monthly",
    "energy_cost_year",
    "producer_year",
    "sector_year",
    "yb_hierarchy",
    "yb_drop_title_rows",
    "dq_suite",
    "dq_unique_combo",
    "dq_relationships",
    "rpt_clean_vs_incident",
    "rpt_histogram",
    "rpt_truck_summary",
]


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, "bench")
    names = sys.argv[1:] or HEADLINE
    first = {name: seconds(spark, name) for name in names}  # with compilation of each query's code
    took = {name: seconds(spark, name) for name in names}
    line = {"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took}
    print(json.dumps({**line, "first_run": first, "sf": Path(SF_DIR).name, "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
