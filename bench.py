"""Times every registered query, and one staging-to-warehouse run, and prints one JSON line.

BENCH_SF_DIR   test tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local master (default: all)
BENCH_QUERIES  comma-separated names (default: all)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymill.plans import registry  # noqa: E402
from tallymill.plans.batch import append_staging, run  # noqa: E402
from tallymill.session import build_session, new_work_path  # noqa: E402
from tallymill.sources.testviews import view  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
CHOSEN = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def timed(work) -> float:
    begun = time.perf_counter()
    work()
    return round(time.perf_counter() - begun, 3)


def main() -> None:
    spark = build_session(
        "tallymill-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        extra={
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    # One query unmeasured: it loads classes and lets the compiler warm up.
    queries["top_products_by_revenue"](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, query in queries.items():
        if CHOSEN and name not in CHOSEN:
            continue
        times[name] = timed(
            lambda q=query: q(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )

    extra = {}
    if not CHOSEN or "etl_run" in CHOSEN:
        root = new_work_path(spark, "bench")
        # Staging grows by many files; one per thread stands for that here.
        for table in registry.KEY_OF_FEED:
            append_staging(
                view(spark, SF_DIR, table).repartition(int(CPUS)), f"{root}/staging", table
            )
        reports = []
        times["etl_run"] = timed(
            lambda: reports.append(
                run(spark, f"{root}/staging", f"{root}/warehouse", "bench", registry.AS_OF)
            )
        )
        extra = {
            "etl_run_rows": reports[0].processed,
            "etl_run_rows_per_sec": round(reports[0].processed / times["etl_run"]),
        }

    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1).rstrip(".")) if scale else None,
                "cpus": int(CPUS),
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
