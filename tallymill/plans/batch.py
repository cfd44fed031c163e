"""The staging-to-warehouse run, and its cleaning step on its own."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymill.operators.cleaning import (
    clean_product_prices,
    clean_sales_numbers,
    enforce_customer_types,
    enforce_product_types,
    enforce_sales_types,
    normalize_blank_strings,
)
from tallymill.operators.duplicates import (
    HELPERS,
    best_customers,
    best_products,
    prepare_customers,
    prepare_products,
    rejected_customers,
    rejected_products,
)
from tallymill.operators.shaping import (
    build_dim_date,
    transform_customers,
    transform_products,
    transform_sales,
)
from tallymill.operators.splits import batch_number, classify_sales, parse_transaction_date
from tallymill.operators.statistics import exact_median
from tallymill.plans.checks import constraint_violations
from tallymill.plans.star import Star
from tallymill.schemas import DIMENSION_KEYS, LEDGER, QUALITY_REPORT, STAGING
from tallymill.session import (
    apply_settings,
    in_parallel,
    settle,
    work_scope,
    write_own_folders,
)
from tallymill.sinks.audit import (
    FAILED,
    SUCCESS,
    feed_watermarks,
    last_watermark,
    record_feeds,
    record_run,
)
from tallymill.sinks.publication import LOAD, Snapshot, of_load, publish, read_snapshot, reserve_load
from tallymill.sinks.quarantine import (
    LOADED,
    MISFIT,
    STAGE_OF_FEED,
    quality_counts,
    write_rejects,
)
from tallymill.sinks.staging import append_batch
from tallymill.sinks.warehouse import (
    create_tables,
    fact_days,
    load_dimension,
    load_fact,
)
from tallymill.sources.tables import (
    ROW_CORRUPT,
    ROW_OK,
    folder_names,
    path_exists,
    read_delivered,
    read_dimension_keys,
    read_folders,
    read_load,
    read_staging,
    read_table,
    read_warehouse,
    single_row,
)

logger = logging.getLogger(__name__)

SALES_CLEAN = "clean"


@dataclass(frozen=True)
class Batch:
    """Staged rows of the three feeds."""

    customers: DataFrame
    products: DataFrame
    sales: DataFrame


@dataclass(frozen=True)
class RunReport:
    run_id: str
    processed: int
    rejected: int
    loaded: int
    watermark: datetime


def extract(spark: SparkSession, staging: str, after: datetime | dict[str, datetime]) -> Batch:
    """Rows ingested after the watermark, which may be each feed's own. File lists are fixed here,
    once for the whole run."""
    since = after if isinstance(after, dict) else dict.fromkeys(STAGING, after)
    customers, products, sales = "customers_stage", "products_stage", "sales_transactions_stage"
    return Batch(
        read_staging(spark, staging, customers, since[customers], row_ids=True),
        read_staging(spark, staging, products, since[products], row_ids=True),
        read_staging(spark, staging, sales, since[sales]),
    )


# --- cleaning, per feed ---


def clean_customers(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean and typed, rejected with reason); the clean side is a written table."""
    prepared = prepare_customers(normalize_blank_strings(staged))
    best = settle(best_customers(prepared), "customers-best")
    return enforce_customer_types(best.drop(*HELPERS)), rejected_customers(prepared, best)


def clean_products(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    priced = clean_product_prices(normalize_blank_strings(staged))
    prepared = prepare_products(priced)
    best = settle(best_products(prepared), "products-best")
    clean = best.where("is_valid_name").drop(*HELPERS)
    return enforce_product_types(clean), rejected_products(prepared, best)


def prepare_sales(staged: DataFrame, median: float | None = None) -> DataFrame:
    numbers = clean_sales_numbers(normalize_blank_strings(staged), median=median)
    return parse_transaction_date(numbers)


# --- the run ---


@dataclass(frozen=True)
class Cleaned:
    """Cleaned feeds as written tables; ``sales`` holds both outcomes, told by ``outcome``."""

    customers: DataFrame
    products: DataFrame
    sales: DataFrame
    rejects: dict[str, DataFrame]


def clean_batch(
    batch: Batch,
    loaded_customers: DataFrame | None = None,
    loaded_products: DataFrame | None = None,
) -> Cleaned:
    """All cleaning steps. The sales are read twice: the price column alone for its median, then
    whole, to be classified and written once, split by outcome."""
    spark = batch.sales.sparkSession
    (customers, bad_customers), (products, bad_products), median = in_parallel(
        spark,
        lambda: clean_customers(batch.customers),
        lambda: clean_products(batch.products),
        lambda: exact_median(batch.sales, "unit_price"),
    )
    classified = classify_sales(
        prepare_sales(batch.sales, median),
        [customers, *([loaded_customers] if loaded_customers else [])],
        [products, *([loaded_products] if loaded_products else [])],
    )
    sales = settle(
        classified.withColumn("outcome", F.coalesce("reject_reason", F.lit(SALES_CLEAN))),
        "sales-classified",
        partition_by="outcome",
    )
    rejects = {
        "customers_stage": bad_customers,
        "products_stage": bad_products,
        "sales_transactions_stage": sales.where(F.col("outcome") != SALES_CLEAN)
        .drop("outcome")
        .withColumn("batch_idx", batch_number(F.col("reject_reason"))),
    }
    return Cleaned(customers, products, sales, rejects)


def write_all_rejects(
    cleaned: Cleaned, folder: str, run_id: str, file_format: str, number: int
) -> None:
    """Quarantine of the three feeds."""

    def write(table: str):
        stage = STAGE_OF_FEED.get(table) or F.lower("reject_reason")
        return lambda: write_rejects(
            cleaned.rejects[table], f"{folder}/{table}", run_id, stage, file_format, number
        )

    in_parallel(cleaned.sales.sparkSession, *[write(table) for table in cleaned.rejects])


def load(
    spark: SparkSession,
    warehouse: str,
    cleaned: Cleaned,
    as_of: date | None,
    snapshot: Snapshot,
    number: int,
) -> int:
    """Write the load's dimensions side by side, then the fact; returns its rows. Nothing of it
    counts until it is published."""
    clean_sales = cleaned.sales.where(F.col("outcome") == SALES_CLEAN)
    facts = transform_sales(enforce_sales_types(clean_sales))

    def dimension(table: str, rows: Callable[[], DataFrame]) -> Callable[[], None]:
        return lambda: load_dimension(spark, warehouse, rows(), table, snapshot, number)

    *_, days_in_batch = in_parallel(
        spark,
        dimension("dim_customer", lambda: transform_customers(cleaned.customers, as_of)),
        dimension("dim_product", lambda: transform_products(cleaned.products)),
        dimension("dim_date", lambda: build_dim_date(clean_sales)),
        lambda: fact_days(facts),
    )
    return load_fact(spark, warehouse, facts, days_in_batch, snapshot, number)


class ConstraintError(ValueError):
    """A load's rows would break the warehouse's constraints."""


def check_constraints(spark: SparkSession, warehouse: str, snapshot: Snapshot, number: int) -> None:
    """Refuse a load that is written but not published."""
    tables = [*DIMENSION_KEYS, "fact_sales"]
    new = Star(*[read_load(spark, warehouse, table, number) for table in tables])
    loaded = Star(*[read_warehouse(spark, warehouse, table, snapshot) for table in tables])
    broken = constraint_violations(new, loaded).where(F.col("violations") > 0).collect()
    if broken:
        raise ConstraintError("; ".join(f"{t}: {c}: {n}" for t, c, n in sorted(broken)))


class AccountingError(ValueError):
    """Rows of a feed were lost or counted twice on the way."""


def ledger(spark: SparkSession, quality: DataFrame, delivered: dict[str, int], run_id: str, number: int) -> DataFrame:
    """Per feed what was delivered, and what the quality report says became of it."""
    counted = F.col("row_count")
    loaded, misfit = F.col("reason") == LOADED, F.col("reason") == MISFIT
    found = quality.groupBy("table_name").agg(
        F.sum(F.when(misfit, counted).otherwise(0)).alias("misfit"),
        F.sum(F.when(~misfit & ~loaded, counted).otherwise(0)).alias("rejected"),
        F.sum(F.when(loaded, counted).otherwise(0)).alias("loaded"),
    )
    feeds = reduce(
        DataFrame.unionByName,
        [
            spark.range(1).select(F.lit(t).alias("table_name"), F.lit(n).cast("long").alias("delivered"))
            for t, n in delivered.items()
        ],
    )
    none = {c: F.coalesce(c, F.lit(0)) for c in ("misfit", "rejected", "loaded")}
    rows = feeds.join(found, "table_name", "left").withColumns(
        {"run_id": F.lit(run_id), "load": F.lit(number), **none}
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields])


def check_ledger(rows: DataFrame) -> None:
    lost = rows.where(F.col("delivered") != F.col("misfit") + F.col("rejected") + F.col("loaded")).collect()
    if lost:
        raise AccountingError("; ".join(str(row.asDict()) for row in lost))


@dataclass(frozen=True)
class Extracted:
    """A feed's increment: fitting rows, misfit rows, all rows as they lie in staging, newest stamp."""

    fitting: int
    misfit: int
    newest: datetime | None


def _extracted(spark: SparkSession, staging: str, table: str, after: datetime) -> Extracted:
    rows = read_delivered(spark, staging, table, after)
    row = rows.agg(
        F.count_if(F.col("row_status") == ROW_OK).alias("fitting"),
        F.count_if(F.col("row_status") == ROW_CORRUPT).alias("misfit"),
        F.max("ingest_date").alias("newest"),
    ).first()
    return Extracted(*row)


def _clean_and_load(
    batch: Batch,
    warehouse: str,
    run_id: str,
    as_of: date | None,
    batch_only: bool,
    quarantine: str,
    csv_rejects: str | None,
    sizes: dict[str, Extracted],
) -> int:
    """Writes, checks and publishes one load; returns the number of clean sales."""
    spark = batch.sales.sparkSession
    snapshot = read_snapshot(spark, warehouse)
    number = reserve_load(spark, warehouse, run_id)
    loaded_keys = [
        None if batch_only else read_dimension_keys(spark, warehouse, table, snapshot)
        for table in ("dim_customer", "dim_product")
    ]
    cleaned = clean_batch(batch, *loaded_keys)

    def quarantine_and_report() -> DataFrame:
        write_all_rejects(cleaned, quarantine, run_id, "parquet", number)
        misfits = {table: size.misfit for table, size in sizes.items()}
        return settle(quality_report(spark, quarantine, run_id, cleaned, number, misfits), "quality")

    steps = [
        quarantine_and_report,
        lambda: load(spark, warehouse, cleaned, as_of, snapshot, number),
    ]
    if csv_rejects:
        steps.append(lambda: write_all_rejects(cleaned, csv_rejects, run_id, "csv", number))
    report, new_sales, *_ = in_parallel(spark, *steps)
    delivered = {table: size.fitting + size.misfit for table, size in sizes.items()}
    accounts = settle(ledger(spark, report, delivered, run_id, number), "ledger")
    check_ledger(accounts)
    check_constraints(spark, warehouse, snapshot, number)
    quality = of_load(report, number).coalesce(1)
    write_own_folders(quality, f"{warehouse}/etl_data_quality_report", LOAD)
    write_own_folders(accounts.coalesce(1), f"{warehouse}/etl_run_ledger", LOAD)
    publish(spark, warehouse, snapshot, number, new_sales)
    clean_sales = accounts.where(F.col("table_name") == "sales_transactions_stage")
    return clean_sales.select("loaded").first()[0]


def run(
    spark: SparkSession,
    staging: str,
    warehouse: str,
    run_id: str,
    as_of: date | None = None,
    batch_only: bool = False,
    quarantine: str | None = None,
    csv_rejects: str | None = None,
) -> RunReport:
    """Load what was ingested since the last successful run.

    Everything a run writes is published together, by one marker, after its rows were found to
    add up and to keep the constraints; of a run that died nothing is seen, and the next one takes
    its rows up again. Of two runs at once one is published and the other fails. Each feed's
    watermark moves to its newest extracted row, and only when the run succeeds; the log shows the
    newest of all. ``batch_only`` checks sales against the dimensions of this batch alone.
    ``csv_rejects`` names a folder for CSV copies of rejects.
    """
    apply_settings(spark)
    quarantine = quarantine or f"{warehouse}/quarantine"
    audit = f"{warehouse}/etl_audit_log"
    feeds = f"{warehouse}/etl_feed_watermarks"
    watermark = last_watermark(spark, audit)
    processed = rejected = loaded = 0
    try:
        since = feed_watermarks(spark, feeds, watermark)
        batch = extract(spark, staging, since)
        *found, _ = in_parallel(
            spark,
            *[partial(_extracted, spark, staging, feed, since[feed]) for feed in since],
            lambda: create_tables(spark, warehouse),
        )
        sizes = dict(zip(since, found, strict=True))
        processed = sum(size.fitting for size in found)
        newest = max([watermark, *[size.newest for size in found if size.newest is not None]])
        if processed or any(size.misfit for size in found):
            with work_scope(spark, run_id):
                loaded = _clean_and_load(
                    batch, warehouse, run_id, as_of, batch_only, quarantine, csv_rejects, sizes
                )
            record_feeds(
                spark,
                feeds,
                {feed: size.newest or since[feed] for feed, size in sizes.items()},
                {feed: size.fitting for feed, size in sizes.items()},
            )
        rejected = sizes["sales_transactions_stage"].fitting - loaded
        record_run(spark, audit, newest, processed, rejected, loaded, SUCCESS)
        return RunReport(run_id, processed, rejected, loaded, newest)
    except Exception:
        logger.exception("run %s failed", run_id)
        # Another run may have moved the watermark meanwhile.
        record_run(spark, audit, last_watermark(spark, audit), processed, rejected, 0, FAILED)
        raise


def read_quality(spark: SparkSession, warehouse: str) -> DataFrame:
    """The data-quality report of all published runs."""
    layout = StructType([*QUALITY_REPORT.fields, LEDGER["load"]])
    rows = read_table(spark, f"{warehouse}/etl_data_quality_report", layout)
    return rows.where(read_snapshot(spark, warehouse).counts())


def read_ledger(spark: SparkSession, warehouse: str) -> DataFrame:
    """Delivered, misfit, rejected and loaded rows per published load and feed."""
    rows = read_table(spark, f"{warehouse}/etl_run_ledger", LEDGER)
    return rows.where(read_snapshot(spark, warehouse).counts())


def quality_report(
    spark: SparkSession,
    quarantine: str,
    run_id: str,
    cleaned: Cleaned,
    load: int,
    misfits: dict[str, int],
) -> DataFrame:
    """Rows per table, stage and reason of a run whose rejects are written.

    Counted from written tables, of which only footers and reason columns are read; metrics
    gathered on the way would count the rows of repeated tasks again.
    """

    def clean_part(df: DataFrame, table: str) -> DataFrame:
        none = F.lit(None).cast("string")
        return quality_counts(df.withColumn("reject_reason", none), run_id, table, F.lit("load"))

    def reject_part(table: str) -> DataFrame:
        columns = StructType.fromDDL("reject_reason string, reject_stage string, run_id string")
        path = f"{quarantine}/{table}"
        of_run = [f"{stage}/run_id={run_id}/load={load}" for stage in folder_names(spark, path)]
        present = [folder for folder in of_run if path_exists(spark, f"{path}/{folder}")]
        rows = read_folders(spark, path, columns, present)
        return quality_counts(rows, run_id, table, F.col("reject_stage"))

    stage = F.coalesce(F.lower("reject_reason"), F.lit("load"))
    report = quality_counts(cleaned.sales, run_id, "sales_transactions_stage", stage)
    for table, clean in (
        ("customers_stage", cleaned.customers),
        ("products_stage", cleaned.products),
    ):
        report = report.unionByName(clean_part(clean, table)).unionByName(reject_part(table))
    for table, n in misfits.items():
        # Their raw lines lie in staging, under row_status=corrupt.
        told = {"run_id": run_id, "table_name": table, "stage": "staging", "reason": MISFIT, "row_count": n}
        report = report.unionByName(single_row(spark, QUALITY_REPORT, **told).where("row_count > 0"))
    return report


def append_staging(df: DataFrame, staging: str, table: str, batch: str | None = None) -> None:
    """Batch append to staging. A batch that is named adds its rows once, however often it is
    appended; an unnamed one is another batch each time."""
    append_batch(df, staging, table, batch or uuid.uuid4().hex)
