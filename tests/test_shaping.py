from datetime import date
from decimal import Decimal

from tallymill.operators.shaping import (
    build_dim_date,
    to_dimension,
    to_fact,
    transform_customers,
    transform_products,
    transform_sales,
)
from tallymill.schemas import FACT_COLUMNS, WAREHOUSE
from tests.conftest import values

DAY = date(2024, 1, 1)


def test_customers(frame):
    df = frame(
        "customer_id int, customer_name string, email string, city string, state string,"
        "signup_date date, ingest_date string",
        (1, "A", "Me@X.COM", "Rome", "ny", date(2020, 1, 1), "x"),
        (2, "B", None, None, None, None, "x"),
        (3, "C", "c@d", "Oslo", "ca", None, "x"),
    )
    got = transform_customers(df, DAY)
    # city and state are tied: the smaller value is taken
    assert values(got.drop("ingest_date")) == [
        (1, "A", "me@x.com", "Rome", "NY", date(2020, 1, 1)),
        (2, "B", "unknown@example.com", "Oslo", "CA", DAY),
        (3, "C", "c@d", "Oslo", "CA", DAY),
    ]
    assert to_dimension(got, "dim_customer").schema.simpleString() == WAREHOUSE["dim_customer"].simpleString()


def test_all_cities_missing(frame):
    df = frame(
        "customer_id int, email string, city string, state string, signup_date date",
        (1, None, None, None, DAY),
    )
    assert values(transform_customers(df, DAY), "city", "state") == [(None, None)]


def test_products(frame):
    df = frame(
        "product_id int, product_name string, category string, brand string",
        (1, " Big Lamp ", " HOME", None), (2, "Chair", None, None),
    )
    assert values(transform_products(df)) == [
        (1, "big lamp", "home", "unknown"), (2, "chair", "home", "unknown")
    ]


def test_sales_measures(frame):
    df = frame(
        "customer_id long, product_id long, transaction_date date, quantity int,"
        "unit_price double, discount double",
        (1, 2, date(2024, 3, 9), 4, 229.835, None), (1, 2, date(2024, 3, 9), 1, 1.015, 5.0),
        (1, 2, date(2024, 3, 9), 1, 7.0, float("nan")),
    )
    got = transform_sales(df)
    assert values(got, "total_sale_amount", "net_sale_amount", "discount_amount", "date_id") == [
        (Decimal("1.01"), Decimal("-3.99"), 5.0, 20240309),
        (Decimal("7.00"), Decimal("7.00"), 0.0, 20240309),
        (Decimal("919.34"), Decimal("919.34"), 0.0, 20240309),
    ]
    assert values(got, "order_year", "order_month", "order_day")[0] == (2024, 3, 9)
    assert to_fact(got).columns == FACT_COLUMNS


def test_calendar(frame):
    df = frame("transaction_date date", (date(2024, 6, 1),), (date(2024, 6, 1),), (None,))
    got = build_dim_date(df)
    assert values(got) == [(20240601, date(2024, 6, 1), 1, 6, 2, 2024, "Saturday")]
    assert to_dimension(got, "dim_date").schema.simpleString() == WAREHOUSE["dim_date"].simpleString()
