"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from tallymill.plans import analytics, checks, oracles, registry
from tallymill.sources.testviews import star, view
from tests.conftest import SMALL
from tests.sql_check import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_each_query_has_its_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["product_id", "product_name", "total_revenue"]
    assert df.count() == 10


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


REPORTS = [
    analytics.top_products_by_revenue,
    analytics.monthly_revenue,
    analytics.avg_order_value,
    analytics.top_customers_by_ltv,
    analytics.category_revenue_share,
    analytics.customer_retention,
    analytics.customer_retention_fixed,
    analytics.rolling_3_month_avg,
    analytics.best_product_per_month,
    analytics.declining_customers,
    analytics.revenue_by_day_type,
]


@pytest.mark.parametrize("report", REPORTS, ids=lambda r: r.__name__)
def test_reports_stay_in_the_jvm_and_never_cross(spark, report):
    text = plan(report(star(spark, SMALL)))
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(analytics.top_products_by_revenue(star(spark, SMALL)))


def test_sums_are_combined_before_the_join(spark):
    text = plan(analytics.top_customers_by_ltv(star(spark, SMALL)))
    join_with_names = text.index("c_name")
    assert "partial_sum" in text and text.index("Join") < text.index("partial_sum")
    assert join_with_names


def test_leaders_are_cut_before_the_shuffle(spark):
    text = plan(analytics.best_product_per_month(star(spark, SMALL)))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_columns_are_pruned(spark):
    text = plan(checks.duplicate_fact_grain(view(spark, SMALL, "fact_sales")))
    lineitem = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_partkey" in s)
    assert set(re.findall(r"(\w+):", lineitem)) == {"l_orderkey", "l_partkey"}
