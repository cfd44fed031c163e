"""Dropped files to reports, through the command line, and the test views' known properties."""

import os
from datetime import date

from pyspark.sql import functions as F

from tallymill.__main__ import main
from tallymill.operators.statistics import exact_median
from tallymill.plans.batch import append_staging, run
from tallymill.schemas import STAGING
from tallymill.sources.tables import empty_table, read_staging, read_warehouse
from tallymill.sources.testviews import view
from tallymill.streaming.file_ingest import drop_csv, ingest
from tests.conftest import SMALL, values


def test_drop_ingest_load_report(spark, folder, capsys):
    drop = f"{folder}/drop"
    staging, warehouse, checkpoints = f"{folder}/staging", f"{folder}/wh", f"{folder}/checkpoints"
    os.makedirs(drop)
    texts = {
        "customers.csv": "customer_id,customer_name,email,city,state,signup_date\n1,Ann,,Rome,ny,2023-01-01\n",
        "products.csv": "product_id,product_name,category,brand,unit_price\n7,Lamp,Home,Acme,10\n",
        "transactions.csv": "transaction_id,customer_id,product_id,transaction_date,quantity,"
        "unit_price,discount\n1,1,7,2024-01-05,2,10,1\n2,1,8,2024-01-05,2,10,1\n",
    }
    for name, text in texts.items():
        with open(f"{drop}/{name}", "w") as out:
            out.write(text)
    main(["ingest", drop, staging, checkpoints, "--once"])
    main(["load", staging, warehouse, "--run-id", "r1", "--as-of", "2024-02-01"])
    assert "processed=4, rejected=1, loaded=1" in capsys.readouterr().out
    main(["report", warehouse, "top_products_by_revenue"])
    assert "19.00" in capsys.readouterr().out
    for name in ("orphan_fact_dates", "total_reconciliation"):
        main(["report", warehouse, name])
    assert "20.00" in capsys.readouterr().out

    # A table may be filled by a stream and by appends.
    append_staging(empty_table(spark, STAGING["customers_stage"]), staging, "customers_stage")
    assert read_staging(spark, staging, "customers_stage").count() == 1


def test_streamed_and_appended_staging_load_alike(spark, folder):
    tables = list(STAGING)
    for table in tables:
        rows = view(spark, SMALL, table).drop("row_id")
        append_staging(rows, f"{folder}/appended", table)
        drop_csv(rows.drop("ingest_date"), f"{folder}/drop", table)
    ingest(spark, f"{folder}/drop", f"{folder}/streamed", f"{folder}/checkpoints")
    for way in ("appended", "streamed"):
        run(spark, f"{folder}/{way}", f"{folder}/wh-{way}", "r", date(2024, 1, 1))
    for table in ("dim_customer", "dim_product", "dim_date", "fact_sales"):
        one, two = (read_warehouse(spark, f"{folder}/wh-{w}", table).drop("sales_id") for w in ("appended", "streamed"))
        assert one.count() > 0
        assert values(one) == values(two)


def test_known_properties_of_the_views(spark):
    counts = {t: view(spark, SMALL, t).count() for t in STAGING}
    assert counts == {
        "customers_stage": 156, "products_stage": 205, "sales_transactions_stage": 6000
    }
    sales = view(spark, SMALL, "sales_transactions_stage")
    assert exact_median(sales, "unit_price") == 909.4
    fact = view(spark, SMALL, "fact_sales")
    assert str(fact.agg(F.sum("net_sale_amount")).first()[0]) == "138488200.10"
