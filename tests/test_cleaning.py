import math
import re
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymill.operators.cleaning import (
    check_schema,
    clean_product_prices,
    clean_sales_numbers,
    enforce_column_types,
    enforce_customer_types,
    enforce_product_types,
    enforce_sales_types,
    impute_transaction_dates,
    normalize_blank_strings,
    schema_findings,
)
from tallymill.operators.splits import classify_sales
from tallymill.plans.batch import prepare_sales
from tallymill.schemas import STAGING
from tallymill.session import settle
from tests.conftest import values


def test_normalize_touches_text_only(frame):
    df = frame("a string, n int, b string", (" ", 1, "x "), ("", None, " "), (None, 3, "y"))
    assert set(values(normalize_blank_strings(df))) == {
        (None, 1, "x "), (None, None, None), (None, 3, "y")
    }


def test_sales_numbers(frame):
    df = frame(
        "quantity double, unit_price double",
        (None, -20.0), (-3.0, 0.0), (2.9, None), (4.0, 10.0), (math.nan, math.nan),
    )
    # the median is that of -20, 0, 10 as delivered
    assert values(clean_sales_numbers(df).drop("misfit_values")) == sorted(
        [(0, 20.0), (3, 0.0), (2, 0.0), (4, 10.0), (0, 0.0)], key=lambda r: tuple(map(str, r))
    )


def test_sales_numbers_without_any_price(frame):
    df = frame("quantity double, unit_price double", (1.0, None))
    assert values(clean_sales_numbers(df).drop("misfit_values")) == [(1, None)]


def test_product_prices_use_the_cleaned_median(frame):
    df = frame("unit_price double", (-10.0,), (0.0,), (None,), (30.0,), (40.0,))
    assert values(clean_product_prices(df)) == [(10.0,), (30.0,), (30.0,), (30.0,), (40.0,)]


NOW = datetime(2024, 1, 1)


def test_final_types(frame):
    sales = frame(
        "transaction_id string, customer_id double, product_id int, quantity double,"
        "unit_price string, discount int, transaction_date string, ingest_date timestamp_ntz",
        ("7", 1.0, 2, 3.0, "4.5", 1, "2024-01-05", NOW),
        ("8", 1.0, 2, 3.0, "4.5", None, "2024-99-99", NOW),
    )
    assert values(enforce_sales_types(sales)) == [
        (7, 1, 2, 3, 4.5, 1.0, date(2024, 1, 5), NOW), (8, 1, 2, 3, 4.5, None, None, NOW)
    ]
    customers = frame(
        "customer_id int, customer_name string, email string, city string, state string,"
        "signup_date string, ingest_date timestamp_ntz",
        (1, " A ", None, "c", "s", "bad", NOW),
    )
    assert values(enforce_customer_types(customers)) == [(1, " A ", None, "c", "s", None, NOW)]
    products = frame(
        "product_id int, product_name string, category string, brand string, unit_price string,"
        "ingest_date timestamp_ntz",
        (1, " Lamp ", " Home", None, "2", NOW),
    )
    assert values(enforce_product_types(products)) == [(1, "Lamp", "Home", None, 2.0, NOW)]


def test_a_bad_number_stops_the_run(frame):
    bad = frame(
        "transaction_id string, customer_id int, product_id int, quantity int, unit_price double,"
        "discount double, transaction_date string, ingest_date timestamp_ntz",
        ("x", 1, 1, 1, 1.0, 0.0, "2024-01-01", NOW),
    )
    with pytest.raises(PySparkException):
        enforce_sales_types(bad).collect()


def test_type_map(frame):
    df = frame("a string, d string", ("1", "2024-01-02 03:04:05"), (None, "junk"))
    typed = enforce_column_types(df, {"a": "int", "d": "datetime"}, "t")
    assert values(typed) == [(1, datetime(2024, 1, 2, 3, 4, 5)), (None, None)]
    with pytest.raises(PySparkException, match="orders: invalid int in column 'd'"):
        enforce_column_types(df, {"d": "int"}, "orders").collect()
    with pytest.raises(ValueError, match="no such column"):
        enforce_column_types(df, {"zz": "int"}, "t")


def test_schema_check(frame):
    expected = STAGING["products_stage"]
    df = frame(
        "product_id string, product_name string, category string, brand string,"
        "unit_price double, ingest_date date, color string",
        ("1", "a", "b", "c", 1.0, date(2024, 1, 1), "red"),
    )
    found = {(f.column, f.kind) for f in check_schema(df, expected, "products_stage")}
    # a date where a timestamp is expected is of the same family
    assert found == {("product_id", "type"), ("color", "extra")}
    with pytest.raises(ValueError, match=r"missing required columns \['brand'\]"):
        check_schema(df.drop("brand"), expected, "products_stage")
    assert ("brand", "missing") in {
        (f.column, f.kind) for f in schema_findings(df.drop("brand"), expected, "p")
    }


def test_impute_dates(frame):
    sales = frame(
        "transaction_id int, customer_id int, transaction_date string",
        (1, 1, "2024-05-05"), (2, 1, None), (3, 2, "junk"), (4, 9, None), (5, None, None),
    )
    customers = frame(
        "customer_id int, signup_date string",
        (1, "2020-02-02"), (1, "2019-01-01"), (2, "nope"), (None, "2001-01-01"),
    )
    for small_rows in (0, 100):
        got = impute_transaction_dates(sales, customers, as_of=date(2024, 1, 1), small_rows=small_rows)
        assert got.columns == sales.columns
        assert values(got, "transaction_id", "transaction_date") == [
            (1, date(2024, 5, 5)), (2, date(2019, 1, 1)), (3, date(2024, 1, 1)),
            (4, date(2024, 1, 1)), (5, date(2024, 1, 1)),
        ]


def test_many_signups_work_out_the_sales_once(spark):
    sales = spark.range(200).select(
        (F.col("id") % 9).alias("customer_id"), F.when(F.col("id") % 4 > 0, "2024-05-05").alias("transaction_date")
    )
    customers = spark.range(5).select(F.col("id").alias("customer_id"), F.lit("2020-02-02").alias("signup_date"))
    got = impute_transaction_dates(sales, customers, as_of=date(2024, 1, 1), small_rows=0)
    # Both halves are scans of what was written.
    assert "Range" not in got._jdf.queryExecution().executedPlan().toString()
    days = {r[0]: r[1] for r in got.groupBy("transaction_date").count().collect()}
    assert days == {date(2024, 5, 5): 150, date(2020, 2, 2): 28, date(2024, 1, 1): 22}


def test_generated_methods_are_small_enough_to_be_compiled(spark, frame, capsys):
    """HotSpot leaves methods above 8,000 bytes to its interpreter."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STAGING["sales_transactions_stage"].fields)
    sales = prepare_sales(settle(frame(kinds), "no-sales"), 1.0)
    keys = [settle(frame(f"{k} long", (1,)), "keys") for k in ("customer_id", "product_id")]
    marked = classify_sales(sales, keys[:1], keys[1:])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
