"""Loads that race, die or do not add up; the ledger; constraints before publication."""

import threading

import pytest
from pyspark.sql import functions as F

from tallymill.plans import batch
from tallymill.plans.checks import constraint_violations
from tallymill.plans.star import Star
from tallymill.session import in_parallel
from tallymill.sinks import publication
from tallymill.sinks.audit import read_audit
from tallymill.sinks.publication import LoadConflict, Snapshot, read_snapshot, reserve_load
from tallymill.sinks.staging import publish_batch
from tallymill.sources.markers import create_once
from tallymill.sources.tables import CORRUPT_TEXT, SOURCE_FILE, read_staging, read_warehouse
from tests.conftest import values
from tests.test_batch import AS_OF, CUSTOMERS, ONE, PRODUCTS, SALES, TWO, stage


@pytest.fixture
def places(spark, folder):
    staging, warehouse = f"{folder}/staging", f"{folder}/warehouse"
    stage(spark, staging, CUSTOMERS, PRODUCTS, SALES)
    return staging, warehouse


def tables(spark, warehouse):
    return {t: values(read_warehouse(spark, warehouse, t)) for t in ("dim_customer", "dim_product", "dim_date", "fact_sales")}


def test_of_two_runs_at_once_one_is_published(spark, places, monkeypatch):
    staging, warehouse = places
    both, outcomes = threading.Barrier(2, timeout=90), {}
    one_by_one = batch.publish

    def at_once(*args):
        both.wait()
        return one_by_one(*args)

    def attempt(name):
        try:
            outcomes[name] = batch.run(spark, staging, warehouse, name, AS_OF)
        except Exception as error:
            outcomes[name] = error

    monkeypatch.setattr(batch, "publish", at_once)
    in_parallel(spark, lambda: attempt("a"), lambda: attempt("b"))
    monkeypatch.setattr(batch, "publish", one_by_one)
    assert sorted(type(o).__name__ for o in outcomes.values()) == ["LoadConflict", "RunReport"]
    before = tables(spark, warehouse)
    assert len(before["fact_sales"]) == 2 and len(before["dim_customer"]) == 2
    # The loser's failure does not turn the clock back.
    assert values(read_audit(spark, f"{warehouse}/etl_audit_log"), "last_processed_ingest_date") == [(ONE,)]
    assert batch.run(spark, staging, warehouse, "c", AS_OF).processed == 0
    assert tables(spark, warehouse) == before
    assert values(batch.read_ledger(spark, warehouse).groupBy("load").count(), "count") == [(3,)]


@pytest.mark.parametrize("step", ["check_constraints", "publish", "record_feeds"])
def test_a_run_that_dies_is_taken_up_again(spark, places, monkeypatch, step):
    staging, warehouse = places

    def dies(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(batch, step, dies)
        with pytest.raises(RuntimeError, match="killed"):
            batch.run(spark, staging, warehouse, "r", AS_OF)
    published = step == "record_feeds"
    assert len(tables(spark, warehouse)["fact_sales"]) == (2 if published else 0)
    assert len(tables(spark, warehouse)["dim_customer"]) == (2 if published else 0)
    batch.run(spark, staging, warehouse, "r", AS_OF)
    found = tables(spark, warehouse)
    assert [r[0] for r in found["fact_sales"]] == [1, 2]
    assert len(found["dim_customer"]) == 2 and len(found["dim_date"]) == 2
    stage(spark, staging, sales=[(200, 1, 10, "2024-02-01", 1.0, 10.0, 0.0, TWO)])
    batch.run(spark, staging, warehouse, "r", AS_OF)
    assert [r[0] for r in tables(spark, warehouse)["fact_sales"]] == [1, 2, 3]


def test_load_numbers(spark, folder):
    numbers = in_parallel(spark, *[lambda: reserve_load(spark, folder, "r") for _ in range(6)])
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    create_once(spark, publication._numbered(f"{folder}/_loads", 1 << 20), "late")
    assert reserve_load(spark, folder, "r") == (1 << 20) + 1
    first = publication.publish(spark, folder, Snapshot(), 3, 10)
    assert first == read_snapshot(spark, folder) == Snapshot(1, 3, ((1, 2),), 11)
    with pytest.raises(LoadConflict):
        publication.publish(spark, folder, Snapshot(), 2, 10)
    late = publication.publish(spark, folder, first, 6, 0)
    assert late == read_snapshot(spark, folder) == Snapshot(2, 6, ((1, 2), (4, 5)), 11)
    seen = spark.range(1, 10).select(F.col("id").cast("int").alias("load")).where(late.counts())
    assert values(seen) == [(3,), (6,)]


def test_a_late_load_number(spark, places):
    staging, warehouse = places
    create_once(spark, publication._numbered(f"{warehouse}/_loads", 1 << 20), "before")
    batch.run(spark, staging, warehouse, "r", AS_OF)
    assert [r[0] for r in tables(spark, warehouse)["fact_sales"]] == [1, 2]


def misfits(spark, staging, table, count, name="misfits"):
    none = F.lit(None)
    rows = spark.range(count).select(
        *[none.cast(f.dataType).alias(f.name) for f in read_staging(spark, staging, table).schema if f.name != "ingest_date"],
        F.lit(ONE).cast("timestamp_ntz").alias("ingest_date"),
        F.lit("x,y").alias(CORRUPT_TEXT),
        F.lit("bad.csv").alias(SOURCE_FILE),
    )
    publish_batch(staging, table, name, ONE.date(), rows)


def test_the_ledger_of_a_repeated_run_id(spark, places):
    staging, warehouse = places
    misfits(spark, staging, "customers_stage", 4)
    batch.run(spark, staging, warehouse, "same", AS_OF)
    stage(spark, staging, sales=[(200, 1, 10, "2024-02-01", 1.0, 10.0, 0.0, TWO), (201, 1, 10, None, 1.0, 1.0, 0.0, TWO)])
    batch.run(spark, staging, warehouse, "same", AS_OF)
    ledger = values(batch.read_ledger(spark, warehouse), "load", "table_name", "delivered", "misfit", "rejected", "loaded")
    assert ledger == [
        (1, "customers_stage", 7, 4, 1, 2), (1, "products_stage", 4, 0, 2, 2), (1, "sales_transactions_stage", 7, 0, 5, 2),
        (2, "customers_stage", 0, 0, 0, 0), (2, "products_stage", 0, 0, 0, 0), (2, "sales_transactions_stage", 2, 0, 1, 1),
    ]
    quality = batch.read_quality(spark, warehouse)
    assert values(quality.where("reason = 'MISFIT_ROW'"), "table_name", "stage", "row_count") == [("customers_stage", "staging", 4)]
    assert quality.where("reason = 'INVALID_DATE'").agg(F.sum("row_count")).first()[0] == 2
    assert publication.load_runs(spark, warehouse) == {1: "same", 2: "same"}


def test_misfits_alone_move_the_watermark(spark, folder):
    misfits(spark, f"{folder}/staging", "products_stage", 3)
    report = batch.run(spark, f"{folder}/staging", f"{folder}/warehouse", "r", AS_OF)
    assert (report.processed, report.watermark) == (0, ONE)
    assert batch.run(spark, f"{folder}/staging", f"{folder}/warehouse", "r", AS_OF).processed == 0
    assert batch.read_ledger(spark, f"{folder}/warehouse").agg(F.sum("misfit")).first()[0] == 3


def test_lost_rows_stop_the_load(spark, places, monkeypatch):
    staging, warehouse = places
    rejected = batch.rejected_products
    monkeypatch.setattr(batch, "rejected_products", lambda *a: rejected(*a).where("product_id <> 11"))
    with pytest.raises(batch.AccountingError, match="products_stage"):
        batch.run(spark, staging, warehouse, "r", AS_OF)
    assert tables(spark, warehouse)["dim_product"] == []


def test_broken_constraints_stop_the_load(spark, places, monkeypatch):
    staging, warehouse = places
    transform = batch.transform_customers

    def doubled(df, as_of):
        rows = transform(df, as_of)
        return rows.unionByName(rows).unionByName(rows.limit(1).withColumn("customer_id", F.lit(None).cast("long")))

    with monkeypatch.context() as broken:
        broken.setattr(batch, "transform_customers", doubled)
        with pytest.raises(batch.ConstraintError) as refused:
            batch.run(spark, staging, warehouse, "r", AS_OF)
    assert "dim_customer: customer_id NOT NULL: 1" in str(refused.value)
    assert "dim_customer: customer_id UNIQUE: 2" in str(refused.value)
    assert tables(spark, warehouse)["dim_customer"] == []
    assert batch.run(spark, staging, warehouse, "r", AS_OF).loaded == 2


def test_constraints_of_new_rows_against_loaded_ones(frame):
    dims = lambda *keys: [frame(f"{k} long", *[(x,) for x in own]) for k, own in zip(("customer_id", "product_id", "date_id"), keys, strict=True)]
    fact = frame("customer_id long, product_id long, date_id long", (1, 7, 20), (9, 7, 21), (9, None, 20), (2, 7, 20))
    new = Star(*dims([1, 1, 3, None], [7], [20]), fact)
    loaded = Star(*dims([2, 3], [8], []), fact.limit(0))
    found = {(t, c): n for t, c, n in values(constraint_violations(new, loaded)) if n}
    assert found == {
        ("dim_customer", "customer_id NOT NULL"): 1,
        ("dim_customer", "customer_id UNIQUE"): 2,
        ("fact_sales", "customer_id REFERENCES dim_customer"): 2,
        ("fact_sales", "product_id NOT NULL"): 1,
        ("fact_sales", "date_id REFERENCES dim_date"): 1,
    }
