from datetime import date
from decimal import Decimal

import pytest

from tallymill.__main__ import print_rows
from tallymill.plans import analytics, checks
from tallymill.plans.star import Star
from tests.conftest import values


@pytest.fixture
def make_star(frame):
    def make(sales, names=None):
        """``sales``: (customer, product, date, net) rows."""
        ids = {d: d.year * 10000 + d.month * 100 + d.day for _, _, d, _ in sales}
        names = names or {}
        return Star(
            frame(
                "customer_id long, customer_name string",
                *sorted({(c, f"c{c}") for c, *_ in sales}),
            ),
            frame(
                "product_id long, product_name string, category string",
                *sorted({(p, names.get(p, f"p{p}"), f"k{p % 2}") for _, p, *_ in sales}),
            ),
            frame(
                "date_id int, date date, year int, month int, weekday string",
                *[(i, d, d.year, d.month, d.strftime("%A")) for d, i in ids.items()],
            ),
            frame(
                "customer_id long, product_id long, date_id int, quantity int, unit_price double,"
                "total_sale_amount decimal(18,2), net_sale_amount decimal(18,2)",
                *[
                    (c, p, ids[d], 1, None if n is None else float(n), n, n)
                    for c, p, d, n in ((c, p, d, None if n is None else Decimal(n)) for c, p, d, n in sales)
                ],
            ),
        )

    return make


JAN, FEB, MAR, DEC = date(2024, 1, 6), date(2024, 2, 1), date(2024, 3, 1), date(2023, 12, 31)


def test_top_k_ties_go_by_key(make_star):
    star = make_star([(c, c, JAN, "5.00") for c in range(1, 13)] + [(20, 20, JAN, None)])
    top = [r.product_id for r in analytics.top_products_by_revenue(star).collect()]
    assert top == list(range(1, 11))
    assert [r.customer_id for r in analytics.top_customers_by_ltv(star).collect()] == [1, 2, 3, 4, 5]


def test_missing_amounts_count_as_zero_in_means(make_star):
    star = make_star([(1, 1, JAN, "1.00"), (1, 1, JAN, None), (1, 2, FEB, "0.01")])
    assert values(analytics.avg_order_value(star)) == [(1, "c1", Decimal("0.34"))]


def test_monthly_and_rolling(make_star):
    star = make_star(
        [(1, 1, DEC, "10.00"), (1, 1, FEB, "20.00"), (1, 1, MAR, "31.00"), (1, 1, JAN, "0.01")]
    )
    assert [tuple(r) for r in analytics.monthly_revenue(star).collect()] == [
        (2023, 12, Decimal("10.00")), (2024, 1, Decimal("0.01")), (2024, 2, Decimal("20.00")),
        (2024, 3, Decimal("31.00")),
    ]
    averages = [r.rolling_3_month_avg for r in analytics.rolling_3_month_avg(star).collect()]
    # half a cent goes up; rows count, not months
    assert averages == [Decimal(x) for x in ("10.00", "5.01", "10.00", "17.00")]


def test_shares(make_star):
    star = make_star([(1, 1, JAN, "1.00"), (1, 2, JAN, "2.00")])
    assert values(analytics.category_revenue_share(star)) == [
        ("k0", Decimal("2.00"), Decimal("66.67")), ("k1", Decimal("1.00"), Decimal("33.33"))
    ]


def test_retention_over_new_year(make_star):
    star = make_star(
        [(1, 1, DEC, "1.00"), (1, 1, JAN, "1.00"), (1, 1, JAN, "1.00"), (1, 1, FEB, "1.00"),
         (2, 1, JAN, "1.00"), (2, 1, MAR, "1.00")]
    )
    assert values(analytics.customer_retention(star)) == [(2024, 2, 1)]
    assert values(analytics.customer_retention_fixed(star)) == [(2024, 1, 1), (2024, 2, 1)]


def test_best_product_keeps_ties_and_merges_names(make_star):
    star = make_star(
        [(1, 1, JAN, "3.00"), (1, 2, JAN, "2.00"), (1, 3, JAN, "1.00"), (1, 4, FEB, "1.00"),
         (1, 5, FEB, "1.00")],
        names={2: "same", 3: "same"},
    )
    got = values(analytics.best_product_per_month(star), "month", "product_name", "rnk")
    assert got == [(1, "p1", 1), (1, "same", 1), (2, "p4", 1), (2, "p5", 1)]


def test_declining(make_star):
    star = make_star(
        [(1, 1, JAN, "1.00")] * 3 + [(1, 1, MAR, "1.00")] * 2 + [(2, 1, JAN, "1.00"), (2, 1, FEB, "1.00")]
    )
    assert values(analytics.declining_customers(star)) == [(1, 2024, 3, 2, 3)]


def test_weekends(make_star):
    star = make_star([(1, 1, JAN, "1.00"), (1, 1, DEC, "2.00"), (1, 1, FEB, "4.00")])
    assert values(analytics.revenue_by_day_type(star)) == [
        ("Weekday", Decimal("4.00")), ("Weekend", Decimal("3.00"))
    ]


def test_orphans_and_keys(make_star):
    star = make_star([(1, 1, JAN, "1.00"), (2, 2, FEB, "2.00"), (2, 2, FEB, "2.00")])
    assert values(checks.orphan_fact_customers(star)) == [(0,)]
    cut = Star(
        star.dim_customer.where("customer_id = 1"),
        star.dim_product.unionAll(star.dim_product.where("product_id = 1")),
        star.dim_date.where("month = 1"),
        star.fact_sales,
    )
    assert values(checks.orphan_fact_customers(cut)) == [(2,)]
    assert values(checks.orphan_fact_products(cut)) == [(0,)]
    assert values(checks.orphan_fact_dates(cut)) == [(2,)]
    assert values(checks.unique_violations(cut)) == [("dim_product", 1, 2)]
    assert values(checks.not_null_violations(cut)) == [
        ("dim_customer", 0), ("dim_date", 0), ("dim_product", 0)
    ]
    assert values(checks.duplicate_fact_grain(star.fact_sales)) == [(2, 2, 20240201, 2)]


FACT = (
    "quantity int, unit_price double, total_sale_amount decimal(18,2), net_sale_amount decimal(18,2)"
)


def test_amount_checks(frame):
    fact = frame(
        FACT,
        (4, 229.835, Decimal("919.34"), Decimal("919.34")),
        (2, 1.5, Decimal("3.00"), Decimal("4.00")),
        (1, 1.0, Decimal("1.00"), Decimal("-0.01")),
        (1, 1.0, None, None),
    )
    # 4 x 229.84 is 919.36
    assert values(checks.line_total_mismatch(fact), "quantity") == [(4,)]
    assert values(checks.discount_sanity(fact), "quantity") == [(1,), (2,)]
    assert [tuple(map(str, r)) for r in checks.total_reconciliation(fact).collect()] == [
        ("924.34", "923.34")
    ]


def test_date_profile(frame):
    df = frame("transaction_date string", (None,), (" ",), ("2023-99-99",), ("2023-02-31",), ("2024-01-01",))
    assert values(checks.date_issue_profile(df)) == [(5, 4, 1, 1, 1, 2)]
    bad, good = checks.split_by_date_issue(df)
    assert {r[0] for r in bad.select("date_issue_reason").collect()} == {"INVALID_DATE"}
    exact, _ = checks.split_by_date_issue(df, last_wins=False)
    assert sorted(r[0] for r in exact.select("date_issue_reason").collect()) == [
        "EMPTY", "INVALID_DATE", "INVALID_DATE", "NULL"
    ]
    assert good.count() == 1
    assert checks.malformed_dates(df).count() == 3  # 2023-02-31 has the right shape
    assert checks.sample_rows(df, 2).count() == 2
    assert checks.shape(df) == (5, 1)


def test_token_rows(frame):
    df = frame("d string", ("NaT",), (None,), ("x",))
    assert values(checks.rows_equal_to_token(df, "d")) == [("NaT",)]


def test_order_puts_nulls_last(frame):
    df = frame("k int, v string", (None, "a"), (2, None), (2, "b"), (1, "c"))
    assert [tuple(r) for r in checks.total_order(df, "k").collect()] == [
        (1, "c"), (2, "b"), (2, None), (None, "a")
    ]


def test_months_meet_summed_rows_only(spark, make_star):
    star = make_star([(1, 1, JAN, "1.00"), (1, 2, FEB, "2.00")])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (analytics.customer_retention, analytics.best_product_per_month, analytics.declining_customers):
            plan = report(star)._jdf.queryExecution().optimizedPlan().toString()
            under_join = plan[plan.rindex("Join Inner, (date_id") :]
            assert "Aggregate [" in under_join.split("\n")[1], plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_printing_says_that_there_is_more(spark, capsys):
    print_rows(spark.range(150), 100)
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 102 and "only the first 100 rows" in out[-1]
    print_rows(spark.range(150), 150)
    assert len(capsys.readouterr().out.splitlines()) == 151
