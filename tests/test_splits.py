from datetime import date

import pytest

from tallymill.operators.splits import (
    CORRUPT_VALUE,
    INVALID_DATE,
    NULL_KEY,
    ORPHAN_KEY,
    RAW_DATE,
    classify_sales,
    detect_corrupt_sales,
    detect_multi_customer_transactions,
    detect_orphan_sales,
    mark_orphans,
    parse_transaction_date,
    validate_transaction_dates,
)
from tests.conftest import values

DATED = "id int, transaction_date date, quantity int, unit_price double"


def test_dates(frame):
    df = frame(
        "id int, transaction_date string",
        (1, "2024-01-05"), (2, "2023-99-99"), (3, None), (4, "2023-02-31"),
    )
    clean, rejected = validate_transaction_dates(df)
    assert values(clean, "id", "transaction_date") == [(1, date(2024, 1, 5))]
    assert values(rejected, "id", RAW_DATE) == [(2, "2023-99-99"), (3, None), (4, "2023-02-31")]


def test_unknown_values_are_not_corrupt(frame):
    """A missing number is no reason to reject, and must not vanish from both sides either."""
    day = date(2024, 1, 1)
    df = frame(
        DATED,
        (1, day, None, 5.0), (2, day, 3, None), (3, day, 0, 5.0), (4, day, 3, -1.0),
        (5, None, 3, 5.0), (6, day, 3, 5.0), (7, day, None, 0.0),
    )
    clean, rejected = detect_corrupt_sales(df)
    assert values(clean, "id") == [(1,), (2,), (6,)]
    assert values(rejected, "id") == [(3,), (4,), (5,), (7,)]


def test_transactions_of_several_customers(frame):
    df = frame(
        "transaction_id int, customer_id int",
        (1, 1), (1, 2), (1, 1), (2, 5), (2, 5), (3, None), (3, 4), (None, 1), (None, 2),
    )
    clean, rejected = detect_multi_customer_transactions(df)
    assert values(rejected) == [(1, 1), (1, 1), (1, 2)]
    assert clean.count() + rejected.count() == df.count()


SALES = (
    "transaction_id int, customer_id int, product_id int, transaction_date string,"
    "quantity int, unit_price double"
)


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_orphans(frame, small_rows):
    sales = frame(
        "transaction_id int, customer_id int, product_id int",
        (1, 1, 1), (2, 9, 1), (3, 1, 9), (4, 9, 9), (5, 2, 1), (6, None, 1), (7, 1, None),
    )
    customers = frame("customer_id int", (1,), (2,), (2,))
    clean, rejected = detect_orphan_sales(
        sales, customers, frame("product_id int", (1,)), small_rows
    )
    assert values(clean, "transaction_id") == [(1,), (5,)]
    assert values(rejected, "transaction_id") == [(2,), (3,), (4,), (6,), (7,)]


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_orphans_of_several_key_tables(frame, small_rows):
    sales = frame("transaction_id int, customer_id int, product_id int", (1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 1))
    tables = [frame("customer_id int", (1,), (2,)), frame("customer_id int", (2,), (3,))]
    marked = mark_orphans(sales, tables, [frame("product_id int", (1,))], small_rows)
    assert values(marked, "transaction_id", "is_orphan") == [
        (1, False), (2, False), (3, False), (4, True)
    ]


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_first_failed_test_names_the_reason(frame, small_rows):
    sales = parse_transaction_date(
        frame(
            SALES,
            (1, 1, 1, "2024-01-01", 1, 1.0),
            (2, 9, 1, "2023-99-99", 0, 1.0),
            (3, 9, 1, "2024-01-01", 0, 1.0),
            (4, 9, 1, "2024-01-01", 1, 1.0),
            (5, None, 1, "2024-01-01", 1, 1.0),
            (None, 1, 1, "2024-01-01", 1, 1.0),
        )
    )
    got = classify_sales(
        sales, [frame("customer_id int", (1,))], [frame("product_id int", (1,))], small_rows
    )
    assert values(got, "transaction_id", "reject_reason") == [
        (1, None), (2, INVALID_DATE), (3, CORRUPT_VALUE), (4, ORPHAN_KEY), (5, NULL_KEY),
        (None, NULL_KEY),
    ]


def test_values_that_no_column_holds_are_rejects(frame):
    from tallymill.operators.cleaning import clean_sales_numbers

    df = frame(
        "transaction_id long, customer_id long, product_id long, transaction_date string, quantity double, unit_price double, discount double",
        (1, 1, 10, "2024-01-01", 3e9, 1.0, 0.0), (2, 1, 10, "2024-01-01", 2.0, 1e17, 0.0), (3, 1, 10, "2024-01-01", 2.0, 5.0, -1e17),
        (4, 1, 10, "2024-01-01", 2.0, 5.0, None), (5, 1, 10, "2024-01-01", -1e300, None, float("nan")), (6, 1, 10, "2024-01-01", None, 5.0, 0.0),
    )
    cleaned = clean_sales_numbers(df, median=5.0)
    told = {r["transaction_id"]: (r["quantity"], r["misfit_values"]) for r in cleaned.collect()}
    assert told[1] == (None, "quantity=3000000000.00")
    assert told[2][1] == "amount=200000000000000000.00;net=200000000000000000.00"
    assert told[3] == (2, "net=100000000000000016.00")
    assert told[4] == (2, None) and told[6] == (0, None)
    assert told[5][0] is None and told[5][1].startswith("quantity=-1.0E300;amount=")
    clean, rejected = detect_corrupt_sales(cleaned)
    assert values(clean, "transaction_id") == [(4,)]
    assert values(rejected, "transaction_id") == [(1,), (2,), (3,), (5,), (6,)]
