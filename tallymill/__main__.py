"""Command line: ``python -m tallymill ingest|load|report ...``."""

from __future__ import annotations

import argparse
import logging
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame

from tallymill.plans import analytics, checks
from tallymill.plans.batch import run
from tallymill.plans.star import Star
from tallymill.session import build_session
from tallymill.streaming.file_ingest import FILES_PER_BATCH, ingest

# ---- fixed values ----
WATCH_SECONDS = 60
# ---- end of fixed values ----

PRINTED_ROWS = 100

REPORTS = [
    "top_products_by_revenue",
    "monthly_revenue",
    "avg_order_value",
    "top_customers_by_ltv",
    "category_revenue_share",
    "customer_retention",
    "customer_retention_fixed",
    "rolling_3_month_avg",
    "best_product_per_month",
    "declining_customers",
    "revenue_by_day_type",
]
STAR_CHECKS = [
    "orphan_fact_customers",
    "orphan_fact_products",
    "orphan_fact_dates",
    "not_null_violations",
    "unique_violations",
]
FACT_CHECKS = [
    "duplicate_fact_grain",
    "line_total_mismatch",
    "total_reconciliation",
    "discount_sanity",
]


def print_rows(rows: DataFrame, limit: int) -> None:
    """The first rows, separated by tabs, and a line that says so if there are more."""
    found = rows.take(limit + 1)
    print(*rows.columns, sep="\t")
    for row in found[:limit]:
        print(*("" if value is None else value for value in row), sep="\t")
    if len(found) > limit:
        print(f"only the first {limit} rows; --limit prints more, --output writes all")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallymill")
    parser.add_argument("--master", help="only outside spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    watch = commands.add_parser("ingest", help="stage dropped CSV files")
    watch.add_argument("folder")
    watch.add_argument("staging")
    watch.add_argument("checkpoints")
    watch.add_argument("--archive")
    watch.add_argument("--seconds", type=int, default=WATCH_SECONDS)
    watch.add_argument("--once", action="store_true", help="stage what is there and stop")
    watch.add_argument("--max-files-per-batch", type=int, default=FILES_PER_BATCH)

    load = commands.add_parser("load", help="staging to warehouse")
    load.add_argument("staging")
    load.add_argument("warehouse")
    load.add_argument("--run-id")
    load.add_argument("--as-of", type=date.fromisoformat)
    load.add_argument("--batch-only", action="store_true")
    load.add_argument("--csv-rejects")

    report = commands.add_parser("report", help="show one report or check")
    report.add_argument("warehouse")
    report.add_argument("name", choices=[*REPORTS, *STAR_CHECKS, *FACT_CHECKS])
    report.add_argument("--limit", type=int, default=PRINTED_ROWS, help="rows to print")
    report.add_argument("--output", help="folder for all rows, as CSV, instead of printing some")

    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(levelname)s | %(message)s")
    spark = build_session(master=args.master)
    if args.command == "ingest":
        ingest(
            spark,
            args.folder,
            args.staging,
            args.checkpoints,
            args.archive,
            args.max_files_per_batch,
            None if args.once else args.seconds,
        )
    elif args.command == "load":
        run_id = args.run_id or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
        print(
            run(
                spark,
                args.staging,
                args.warehouse,
                run_id,
                args.as_of,
                args.batch_only,
                csv_rejects=args.csv_rejects,
            )
        )
    else:
        star = Star.from_warehouse(spark, args.warehouse)
        if args.name in REPORTS:
            rows = getattr(analytics, args.name)(star)
        elif args.name in STAR_CHECKS:
            rows = getattr(checks, args.name)(star)
        else:
            rows = getattr(checks, args.name)(star.fact_sales)
        if args.output:
            rows.write.mode("errorifexists").option("header", True).csv(args.output)
        else:
            print_rows(rows, args.limit)


if __name__ == "__main__":
    main()
