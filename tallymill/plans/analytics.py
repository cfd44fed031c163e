"""Reports over the star schema.

The fact is summed by its own key before it meets a dimension: partial sums are made before the
shuffle, so a hot product or customer sends one row per map task, and the join handles one row
per key instead of the whole fact. Where a month is part of the grouping, the fact is summed by key
and day before it meets the calendar. Joins carry no hints: the planner broadcasts by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.dates import WEEKEND_DAYS
from tallymill.functions.numbers import money, zero_if_null
from tallymill.plans.star import Star

# ---- fixed values ----
TOP_PRODUCTS = 10
TOP_CUSTOMERS = 5
ROLLING_MONTHS = 3
# ---- end of fixed values ----


def _net() -> Column:
    return money(F.col("net_sale_amount"))


def _net_by(star: Star, key: str) -> DataFrame:
    return star.fact_sales.groupBy(key).agg(F.sum(zero_if_null(_net())).alias("net"))


def _by_day(star: Star, key: str, total: Column) -> DataFrame:
    """The fact summed by key and day, with the day's month: raw rows never meet the calendar."""
    days = star.dim_date.select("date_id", "year", "month")
    return star.fact_sales.groupBy(key, "date_id").agg(total).join(days, "date_id").drop("date_id")


def top_products_by_revenue(star: Star, k: int = TOP_PRODUCTS) -> DataFrame:
    names = star.dim_product.select("product_id", "product_name")
    return (
        _net_by(star, "product_id")
        .join(names, "product_id")
        .select("product_id", "product_name", money(F.col("net")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(k)
    )


def top_customers_by_ltv(star: Star, k: int = TOP_CUSTOMERS) -> DataFrame:
    names = star.dim_customer.select("customer_id", "customer_name")
    return (
        _net_by(star, "customer_id")
        .join(names, "customer_id")
        .select("customer_id", "customer_name", money(F.col("net")).alias("lifetime_value"))
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(k)
    )


def monthly_revenue(star: Star) -> DataFrame:
    return (
        _net_by(star, "date_id")
        .join(star.dim_date.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(money(F.sum("net")).alias("monthly_revenue"))
        .orderBy("year", "month")
    )


def avg_order_value(star: Star) -> DataFrame:
    """Mean of the fact rows per customer, a missing amount counted as zero."""
    names = star.dim_customer.select("customer_id", "customer_name")
    return (
        star.fact_sales.groupBy("customer_id")
        .agg(F.sum(zero_if_null(_net())).alias("net"), F.count("*").alias("n"))
        .join(names, "customer_id")
        .select(
            "customer_id",
            "customer_name",
            money(F.col("net") / F.col("n")).alias("avg_order_value"),
        )
        .orderBy(F.desc("avg_order_value"), "customer_id")
    )


def category_revenue_share(star: Star) -> DataFrame:
    categories = star.dim_product.select("product_id", "category")
    revenue = (
        _net_by(star, "product_id")
        .join(categories, "product_id")
        .groupBy("category")
        .agg(money(F.sum("net")).alias("revenue"))
    )
    # A scalar subquery, one value: no cross join, and it reuses the shuffle of the sums.
    total = revenue.agg(F.sum("revenue")).scalar()
    share = F.round(F.try_divide(F.col("revenue"), total) * 100, 2)
    return revenue.select("category", "revenue", share.alias("revenue_pct")).orderBy(
        F.desc_nulls_first("revenue_pct"), "category"
    )


def _retained(star: Star, follows: Column) -> DataFrame:
    """Customers per month for whom ``follows`` holds against their last month before it.

    One row per customer and month is left after the distinct, so a customer's months are few,
    the month before on record is the one to test, and counting rows counts customers. Joining
    the months to themselves would read the whole fact twice.
    """
    by_time = Window.partitionBy("customer_id").orderBy("year", "month")
    return (
        _by_day(star, "customer_id", F.count("*").alias("n"))
        .where(F.col("customer_id").isNotNull())
        .select("customer_id", "year", "month")
        .distinct()
        .withColumns(
            {
                "prev_year": F.lag("year").over(by_time),
                "prev_month": F.lag("month").over(by_time),
            }
        )
        .where(follows)
        .groupBy("year", "month")
        .agg(F.count("*").alias("retained_customers"))
        .orderBy("year", "month")
    )


def customer_retention(star: Star) -> DataFrame:
    """Customers of a month that also bought in the month before, within the same year."""
    same_year = F.col("year") == F.col("prev_year")
    return _retained(star, same_year & (F.col("month") == F.col("prev_month") + 1))


def customer_retention_fixed(star: Star) -> DataFrame:
    """As above, but December counts as the month before January."""
    index = F.col("year") * 12 + F.col("month")
    prev_index = F.col("prev_year") * 12 + F.col("prev_month")
    return _retained(star, index == prev_index + 1)


def rolling_3_month_avg(star: Star) -> DataFrame:
    """Mean over three result rows. One task sees the months, one row each, never the fact."""
    sales = (
        star.fact_sales.groupBy("date_id")
        .agg(F.sum(_net()).alias("net"))
        .join(star.dim_date.select("date_id", "year", "month"), "date_id")
        .groupBy("year", "month")
        .agg(F.sum("net").cast("decimal(30,2)").alias("monthly_sales"))
    )
    rows = Window.orderBy("year", "month").rowsBetween(1 - ROLLING_MONTHS, Window.currentRow)
    return sales.select(
        "year",
        "month",
        money(F.col("monthly_sales")).alias("monthly_sales"),
        money(F.avg("monthly_sales").over(rows)).alias("rolling_3_month_avg"),
    ).orderBy("year", "month")


def best_product_per_month(star: Star) -> DataFrame:
    """Ranked by name, as ids that share a name are one product here; ties all stay.

    The filter on the rank lets Spark keep only the leaders of each map task, so a month's
    products are never gathered whole.
    """
    by_name = (
        _by_day(star, "product_id", F.sum(_net()).alias("net"))
        .groupBy("year", "month", "product_id")
        .agg(F.sum("net").alias("net"))
        .join(star.dim_product.select("product_id", "product_name"), "product_id")
        .groupBy("year", "month", "product_name")
        .agg(money(F.sum("net")).alias("revenue"))
    )
    best_first = Window.partitionBy("year", "month").orderBy(F.desc_nulls_first("revenue"))
    return (
        by_name.withColumn("rnk", F.rank().over(best_first))
        .where(F.col("rnk") == 1)
        .select("year", "month", "product_name", "revenue", "rnk")
        .orderBy("year", "month")
    )


def declining_customers(star: Star) -> DataFrame:
    """Months in which a customer bought less often than in their month before on record.

    After the count, a customer has at most one row per calendar month.
    """
    counts = (
        _by_day(star, "customer_id", F.count("*").alias("n"))
        .groupBy("customer_id", "year", "month")
        .agg(F.sum("n").alias("order_count"))
    )
    by_time = Window.partitionBy("customer_id").orderBy("year", "month")
    return counts.withColumn("prev_orders", F.lag("order_count").over(by_time)).where(
        F.col("prev_orders").isNotNull() & (F.col("order_count") < F.col("prev_orders"))
    )


def revenue_by_day_type(star: Star) -> DataFrame:
    day_type = F.when(F.col("weekday").isin(WEEKEND_DAYS), "Weekend").otherwise("Weekday")
    return (
        _net_by(star, "date_id")
        .join(star.dim_date.select("date_id", "weekday"), "date_id")
        .groupBy(day_type.alias("day_type"))
        .agg(money(F.sum("net")).alias("total_revenue"))
    )
