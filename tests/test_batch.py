import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymill.plans import batch
from tallymill.plans.analytics import top_products_by_revenue
from tallymill.plans.star import Star
from tallymill.schemas import STAGING, WAREHOUSE
from tallymill.session import work_folder
from tallymill.sinks.audit import read_audit
from tallymill.sources.csv_files import read_rejected_csv
from tallymill.sources.tables import (
    folder_names,
    path_exists,
    read_fact_grain,
    read_staging,
    read_warehouse,
)
from tests.conftest import values

AS_OF = date(2024, 2, 1)
ONE, TWO = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10)

CUSTOMERS = [
    (1, "ANN", "Ann@X.com", "Rome", "ny", "2023-01-01", ONE),
    (1, "OLD ANN", "a@x.com", "Rome", "ny", "2020-01-01", ONE),
    (2, "BOB", "  ", "", "ny", "invalid_date", ONE),
]
PRODUCTS = [
    (10, "Lamp", "Home", None, 10.0, ONE),
    (10, "Stay", "Home", "Acme", 99.0, ONE),
    (11, "Up", "Home", "Acme", 5.0, ONE),
    (12, "Table ", None, "Acme", None, ONE),
]
SALES = [
    (100, 1, 10, "2024-01-05", 2.0, 10.0, 1.5, ONE),
    (101, 2, 12, "2024-01-06", -3.0, None, None, ONE),
    (102, 1, 10, "2023-99-99", 1.0, 10.0, 0.0, ONE),
    (103, 1, 10, "2024-01-05", 0.0, 10.0, 0.0, ONE),
    (104, 1, 11, "2024-01-05", 1.0, 10.0, 0.0, ONE),
    (105, 7, 10, "2024-01-05", 1.0, 10.0, 0.0, ONE),
    (106, None, 10, "2024-01-05", 1.0, 10.0, 0.0, ONE),
]


def stage(spark, staging, customers=(), products=(), sales=()):
    for table, rows in (
        ("customers_stage", customers),
        ("products_stage", products),
        ("sales_transactions_stage", sales),
    ):
        if rows:
            frame = spark.createDataFrame(list(rows), STAGING[table])
            batch.append_staging(frame, staging, table)


@pytest.fixture
def places(spark, folder):
    staging, warehouse = f"{folder}/staging", f"{folder}/warehouse"
    stage(spark, staging, CUSTOMERS, PRODUCTS, SALES)
    return staging, warehouse


def test_a_whole_run(spark, places, folder):
    staging, warehouse = places
    report = batch.run(spark, staging, warehouse, "r1", AS_OF, csv_rejects=f"{folder}/csv")
    assert (report.processed, report.rejected, report.loaded) == (14, 5, 2)
    assert report.watermark == ONE

    assert values(read_warehouse(spark, warehouse, "dim_customer")) == [
        (1, "ANN", "ann@x.com", "Rome", "NY", date(2023, 1, 1)),
        (2, "BOB", "unknown@example.com", "Rome", "NY", AS_OF),
    ]
    # the median of the product prices is that of 10, 99, 5
    assert values(read_warehouse(spark, warehouse, "dim_product")) == [
        (10, "lamp", "home", "acme", 10.0), (12, "table", "home", "acme", 10.0)
    ]
    assert values(read_warehouse(spark, warehouse, "dim_date"), "date_id", "weekday") == [
        (20240105, "Friday"), (20240106, "Saturday")
    ]
    fact = read_warehouse(spark, warehouse, "fact_sales")
    assert values(fact.drop("sales_id")) == [
        (1, 10, 20240105, 2, 10.0, Decimal("20.00"), Decimal("18.50")),
        (2, 12, 20240106, 3, 10.0, Decimal("30.00"), Decimal("30.00")),
    ]
    for table, schema in WAREHOUSE.items():
        assert read_warehouse(spark, warehouse, table).schema == schema

    rejects = spark.read.parquet(f"{warehouse}/quarantine/sales_transactions_stage")
    assert values(rejects, "transaction_id", "reject_stage", "run_id", "batch_idx") == [
        (102, "invalid_date", "r1", 1), (103, "corrupt_value", "r1", 2),
        (104, "orphan_key", "r1", 3), (105, "orphan_key", "r1", 3), (106, "null_key", "r1", 4),
    ]
    products = spark.read.parquet(f"{warehouse}/quarantine/products_stage")
    assert values(products, "product_name", "reject_reason", "is_valid_name") == [
        ("Stay", "DUPLICATE_PRODUCT_ID", False), ("Up", "INVALID_PRODUCT_NAME", False)
    ]
    back = read_rejected_csv(
        spark,
        f"{folder}/csv/customers_stage/*/*/*/*.csv",
        spark.read.parquet(f"{warehouse}/quarantine/customers_stage")
        .drop("reject_stage", "run_id", "load")
        .schema,
    )
    assert values(back, "customer_name", "signup_date") == [("OLD ANN", date(2020, 1, 1))]

    quality = spark.read.parquet(f"{warehouse}/etl_data_quality_report")
    assert values(quality, "table_name", "stage", "reason", "row_count") == [
        ("customers_stage", "customer_duplicates", "DUPLICATE_CUSTOMER_ID", 1),
        ("customers_stage", "load", "LOADED", 2),
        ("products_stage", "load", "LOADED", 2),
        ("products_stage", "product_duplicates", "DUPLICATE_PRODUCT_ID", 1),
        ("products_stage", "product_duplicates", "INVALID_PRODUCT_NAME", 1),
        ("sales_transactions_stage", "corrupt_value", "CORRUPT_VALUE", 1),
        ("sales_transactions_stage", "invalid_date", "INVALID_DATE", 1),
        ("sales_transactions_stage", "load", "LOADED", 2),
        ("sales_transactions_stage", "null_key", "NULL_KEY", 1),
        ("sales_transactions_stage", "orphan_key", "ORPHAN_KEY", 2),
    ]
    assert values(
        read_audit(spark, f"{warehouse}/etl_audit_log"),
        "pipeline_name", "last_processed_ingest_date", "records_processed", "records_rejected",
        "records_loaded", "run_status",
    ) == [("sales_etl", ONE, 14, 5, 2, "SUCCESS")]
    top = top_products_by_revenue(Star.from_warehouse(spark, warehouse))
    assert values(top) == [
        (10, "lamp", Decimal("18.50")), (12, "table", Decimal("30.00"))
    ]


def test_intermediate_tables_are_dropped(spark, places):
    staging, warehouse = places
    work = f"{work_folder(spark)}/{spark.sparkContext.applicationId}"
    batch.run(spark, staging, warehouse, "dropped-run", AS_OF)
    assert not [name for name in os.listdir(work) if name.startswith("dropped-run")]


def test_a_second_run_without_news_changes_nothing(spark, places):
    staging, warehouse = places
    batch.run(spark, staging, warehouse, "r1", AS_OF)
    before = {t: values(read_warehouse(spark, warehouse, t)) for t in WAREHOUSE}
    report = batch.run(spark, staging, warehouse, "r2", AS_OF)
    assert (report.processed, report.loaded, report.watermark) == (0, 0, ONE)
    assert {t: values(read_warehouse(spark, warehouse, t)) for t in WAREHOUSE} == before


def test_a_late_feed_with_an_older_stamp_is_loaded_once(spark, folder):
    staging, warehouse = f"{folder}/staging", f"{folder}/warehouse"
    stage(spark, staging, [(*r[:-1], TWO) for r in CUSTOMERS], [(*r[:-1], TWO) for r in PRODUCTS])
    assert batch.run(spark, staging, warehouse, "r1", AS_OF).loaded == 0
    stage(spark, staging, sales=SALES)
    late = batch.run(spark, staging, warehouse, "r2", AS_OF)
    assert (late.processed, late.loaded, late.watermark) == (len(SALES), 2, TWO)
    assert batch.run(spark, staging, warehouse, "r3", AS_OF).processed == 0
    assert read_warehouse(spark, warehouse, "fact_sales").count() == 2


def test_a_sales_only_batch_uses_the_loaded_dimensions(spark, places):
    staging, warehouse = places
    batch.run(spark, staging, warehouse, "r1", AS_OF)
    stage(
        spark,
        staging,
        sales=[
            (200, 1, 10, "2024-02-01", 1.0, 10.0, 0.0, TWO),
            (201, 1, 10, "2024-01-05", 9.0, 10.0, 0.0, TWO),  # this grain is loaded
            (202, 2, 12, "2024-02-01", 1.0, 7.0, 0.0, TWO),
            (203, 2, 12, "2024-02-01", 2.0, 7.0, 0.0, TWO),  # repeats of the batch stay
        ],
    )
    report = batch.run(spark, staging, warehouse, "r2", AS_OF)
    assert (report.processed, report.rejected, report.loaded) == (4, 0, 4)
    fact = read_warehouse(spark, warehouse, "fact_sales")
    assert values(fact.where("date_id > 20240131"), "customer_id", "quantity") == [
        (1, 1), (2, 1), (2, 2)
    ]
    assert fact.count() == 5
    assert fact.select("sales_id").distinct().count() == 5
    assert read_warehouse(spark, warehouse, "dim_date").count() == 3


def test_batch_only_orphans(spark, places):
    staging, warehouse = places
    batch.run(spark, staging, warehouse, "r1", AS_OF)
    stage(spark, staging, sales=[(200, 1, 10, "2024-02-01", 1.0, 10.0, 0.0, TWO)])
    report = batch.run(spark, staging, warehouse, "r2", AS_OF, batch_only=True)
    assert (report.rejected, report.loaded) == (1, 0)


def test_a_failed_run_is_tried_again(spark, places, monkeypatch):
    """Its watermark stays, and what it loaded before it failed is not loaded twice."""
    staging, warehouse = places

    def no_fact(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(batch, "load_fact", no_fact)
        with pytest.raises(RuntimeError):
            batch.run(spark, staging, warehouse, "r1", AS_OF)
    audit = read_audit(spark, f"{warehouse}/etl_audit_log")
    assert values(audit, "run_status", "records_loaded", "last_processed_ingest_date") == [
        ("FAILED", 0, datetime(1900, 1, 1))
    ]
    report = batch.run(spark, staging, warehouse, "r2", AS_OF)
    assert report.loaded == 2
    assert read_warehouse(spark, warehouse, "dim_customer").count() == 2
    assert read_warehouse(spark, warehouse, "fact_sales").count() == 2


def test_loaded_dimension_rows_are_not_changed(spark, places):
    staging, warehouse = places
    batch.run(spark, staging, warehouse, "r1", AS_OF)
    stage(spark, staging, customers=[(1, "ANNA", "n@x", "Bari", "ba", "2024-01-01", TWO)])
    batch.run(spark, staging, warehouse, "r2", AS_OF)
    names = read_warehouse(spark, warehouse, "dim_customer").where("customer_id = 1")
    assert values(names, "customer_name") == [("ANN",)]


def test_empty_staging(spark, folder):
    report = batch.run(spark, f"{folder}/none", f"{folder}/warehouse", "r1", AS_OF)
    assert report.processed == 0
    for table in WAREHOUSE:
        assert path_exists(spark, f"{folder}/warehouse/{table}")
        assert read_warehouse(spark, f"{folder}/warehouse", table).count() == 0


def test_increment_reads_its_days_only(spark, places):
    staging, _ = places
    stage(spark, staging, sales=[(200, 1, 10, "2024-02-01", 1.0, 10.0, 0.0, TWO)])
    path = f"{staging}/sales_transactions_stage/row_status=ok"
    assert folder_names(spark, path) == ["ingest_day=2024-01-01", "ingest_day=2024-01-02"]
    newer = read_staging(spark, staging, "sales_transactions_stage", after=TWO.replace(hour=0))
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "ingest_day=2024-01-01" not in plan
    assert "GreaterThan(ingest_date" in plan
    assert newer.count() == 1
    # the first day is listed for a watermark within it, and its old rows are filtered
    assert read_staging(spark, staging, "sales_transactions_stage", after=ONE).count() == 1
    assert read_staging(spark, staging, "sales_transactions_stage", after=TWO).count() == 0
    later = TWO.replace(year=2025)
    assert read_staging(spark, staging, "sales_transactions_stage", after=later).count() == 0


def test_loading_reads_the_days_of_the_batch_only(spark, places):
    staging, warehouse = places
    batch.run(spark, staging, warehouse, "r1", AS_OF)
    grain = read_fact_grain(spark, warehouse, [20240105, 20230101])
    assert values(grain) == [(1, 10, 20240105)]
    plan = grain._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "date_month=202401" in plan
    assert "In(date_id" in plan
    schema = plan.split("ReadSchema")[1]
    assert "unit_price" not in schema and "sales_id" not in schema


def test_conservation(spark, places):
    staging, _ = places
    rows = batch.extract(spark, staging, datetime(1900, 1, 1))
    cleaned = batch.clean_batch(rows)
    for name, clean, staged in (
        ("customers_stage", cleaned.customers, rows.customers),
        ("products_stage", cleaned.products, rows.products),
        ("sales_transactions_stage", cleaned.sales.where(F.col("outcome") == "clean"), rows.sales),
    ):
        assert clean.count() + cleaned.rejects[name].count() == staged.count()
