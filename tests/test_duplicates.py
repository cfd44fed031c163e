from collections import Counter
from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymill.operators.duplicates import (
    DUPLICATE_CUSTOMER,
    DUPLICATE_PRODUCT_ID,
    INVALID_PRODUCT_NAME,
    NULL_KEY,
    duplicated_keys,
    resolve_duplicate_customers,
    resolve_duplicate_products,
    rows_with_duplicated_key,
)
from tests.conftest import values

CUSTOMERS = "customer_id long, customer_name string, signup_date string"
PRODUCTS = "product_id long, product_name string, category string, brand string, unit_price double"


def test_latest_valid_signup_wins(frame):
    df = frame(
        CUSTOMERS,
        (1, "old", "2020-01-01"), (1, "new", "2023-01-01"), (1, "bad", "invalid_date"),
        (2, "only bad", "invalid_date"), (None, "nobody", "2020-01-01"),
    )
    clean, rejected = resolve_duplicate_customers(df)
    assert values(clean, "customer_id", "customer_name", "signup_date") == [
        (1, "new", date(2023, 1, 1)), (2, "only bad", None)
    ]
    assert values(rejected, "customer_name", "reject_reason") == [
        ("bad", DUPLICATE_CUSTOMER), ("nobody", NULL_KEY), ("old", DUPLICATE_CUSTOMER)
    ]


def test_exact_copies_leave_one(frame):
    df = frame(CUSTOMERS, *[(1, "same", "2020-01-01")] * 5)
    clean, rejected = resolve_duplicate_customers(df)
    assert clean.count() == 1
    assert rejected.count() == 4


def test_no_rows(frame):
    clean, rejected = resolve_duplicate_customers(frame(CUSTOMERS))
    assert (clean.count(), rejected.count()) == (0, 0)
    clean, rejected = resolve_duplicate_products(frame(PRODUCTS))
    assert (clean.count(), rejected.count()) == (0, 0)


def test_products(frame):
    df = frame(
        PRODUCTS,
        (5, "Stay", "Books", "Smith", 155.6), (5, "Lamp", None, None, 10.0),
        (6, "Building", "A", "B", 234.0), (6, "Parent", "A", "B", 177.2), (6, "Table", "A", "B", 240.0),
        (11, "Up", "Clothing", "Wilson", 27.0), (11, None, "C", "W", 27.0),
        (7, "Chair", None, "B", 900.0), (7, " Stool ", "A", None, 1.0),
        (8, "Desk", "A", "B", 0.0), (8, "Shelf", None, None, 1.0),
        (None, "Ghost", "A", "B", 1.0),
    )
    clean, rejected = resolve_duplicate_products(df)
    assert values(clean, "product_id", "product_name") == [
        (5, "Lamp"), (6, "Table"), (7, "Stool"), (8, "Shelf")
    ]
    assert values(rejected, "product_name", "reject_reason") == [
        ("Building", DUPLICATE_PRODUCT_ID), ("Chair", DUPLICATE_PRODUCT_ID),
        ("Desk", DUPLICATE_PRODUCT_ID), ("Ghost", NULL_KEY), ("Parent", DUPLICATE_PRODUCT_ID),
        ("Stay", DUPLICATE_PRODUCT_ID), ("Up", INVALID_PRODUCT_NAME), (None, INVALID_PRODUCT_NAME),
    ]


def test_all_names_invalid(frame):
    clean, rejected = resolve_duplicate_products(frame(PRODUCTS, (1, "oil", "a", "b", 1.0)))
    assert clean.count() == 0
    assert values(rejected, "reject_reason") == [(INVALID_PRODUCT_NAME,)]


days = st.sampled_from(["2020-01-01", "2021-05-05", "2023-99-99", None])
rows = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]), days), min_size=1, max_size=25
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_customers_against_brute_force(frame, rows):
    clean, rejected = resolve_duplicate_customers(frame(CUSTOMERS, *rows))
    iso = {"2020-01-01": date(2020, 1, 1), "2021-05-05": date(2021, 5, 5)}
    parsed = [(k, n, iso.get(d)) for k, n, d in rows]
    best = {}
    for row in parsed:
        rank = (row[2] or date.min, row[1] or "")
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    kept = Counter(tuple(r) for r in clean.collect())
    columns = ("customer_id", "customer_name", "signup_date")
    lost = Counter(tuple(r) for r in rejected.select(*columns).collect())
    assert kept == Counter(row for _, row in best.values())
    assert kept + lost == Counter(parsed)


def test_duplicated_keys(frame):
    df = frame("k long, v string", (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"))
    assert values(duplicated_keys(df, ["k"], "n")) == [(1, 2)]
    assert values(rows_with_duplicated_key(df, "k"), "k", "v") == [(1, "a"), (1, "b")]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split(spark, folder):
    """A third of the rows share a customer id: the join that sets duplicates aside splits them."""
    settings_here = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings_here}
    try:
        for k, v in settings_here.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        name = F.concat(F.lit("name "), F.col("id").cast("string"))
        df = spark.range(0, 30_000, 1, 8).select(
            hot.cast("long").alias("customer_id"),
            name.alias("customer_name"),
            F.lit("2020-01-01").alias("signup_date"),
        )
        clean, rejected = resolve_duplicate_customers(df)
        assert "skew=true" in final_plan(rejected)
        assert clean.count() + rejected.count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


product_rows = st.lists(
    st.tuples(
        st.integers(0, 3),
        st.sampled_from(["Lamp", " Lamp", "Oil", "Up", None, "Table"]),
        st.sampled_from(["a", None]),
        st.sampled_from(["b", None]),
        st.sampled_from([5.0, 7.0, 0.0, None]),
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(product_rows)
def test_products_against_brute_force(frame, rows):
    clean, rejected = resolve_duplicate_products(frame(PRODUCTS, *rows))
    stripped = [(k, n.strip() if n else n, c, b, p) for k, n, c, b, p in rows]
    expected_clean, expected_rejected = Counter(), Counter()
    for key in {r[0] for r in stripped}:
        group = [r for r in stripped if r[0] == key]
        valid = [r for r in group if r[1] in ("Lamp", "Table")]
        if not valid:
            expected_rejected.update((*r, INVALID_PRODUCT_NAME) for r in group)
            continue
        winner = max(
            valid,
            key=lambda r: (
                (r[4] or 0) > 0, r[2] is not None, r[3] is not None,
                -1 if r[4] is None else r[4], r[1], r[2] or "", r[3] or "",
            ),
        )
        expected_clean[winner] += 1
        group.remove(winner)
        expected_rejected.update((*r, DUPLICATE_PRODUCT_ID) for r in group)
    columns = ["product_id", "product_name", "category", "brand", "unit_price"]
    assert Counter(tuple(r) for r in clean.select(*columns).collect()) == expected_clean
    got = Counter(tuple(r) for r in rejected.select(*columns, "reject_reason").collect())
    assert got == expected_rejected
