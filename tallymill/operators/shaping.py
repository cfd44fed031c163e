"""From clean staged rows to dimension and fact rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.dates import date_key, utc_today, weekday_name
from tallymill.functions.numbers import money, nan_to_null, round_cents
from tallymill.functions.text import strip
from tallymill.operators.statistics import modes
from tallymill.schemas import FACT_COLUMNS, WAREHOUSE

# ---- fixed values ----
UNKNOWN_EMAIL = "unknown@example.com"
UNKNOWN_TEXT = "unknown"
# ---- end of fixed values ----


def transform_customers(
    df: DataFrame, as_of: date | None = None, usual: dict[str, str | None] | None = None
) -> DataFrame:
    """Fill gaps: unknown e-mail, the most usual city and state, ``as_of`` as signup date."""
    usual = usual or modes(df, ["city", "state"])
    return df.withColumns(
        {
            "email": F.lower(F.coalesce("email", F.lit(UNKNOWN_EMAIL))),
            "city": F.coalesce("city", F.lit(usual["city"])),
            "state": F.upper(F.coalesce("state", F.lit(usual["state"]))),
            "signup_date": F.coalesce("signup_date", F.lit(as_of) if as_of else utc_today()),
        }
    )


def transform_products(
    df: DataFrame, usual: dict[str, str | None] | None = None
) -> DataFrame:
    """Fill brand and category with the most usual one, then strip and lower all text."""
    usual = usual or modes(df, ["brand", "category"])

    def tidy(text: Column) -> Column:
        return F.lower(strip(text))

    return df.withColumns(
        {
            **{
                c: tidy(F.coalesce(c, F.lit(usual[c] or UNKNOWN_TEXT)))
                for c in ("brand", "category")
            },
            "product_name": tidy(F.col("product_name")),
        }
    )


def transform_sales(df: DataFrame) -> DataFrame:
    """Line totals, the flat discount taken off, and the parts of the date."""
    total = round_cents(F.col("quantity") * F.col("unit_price"))
    discount = F.coalesce(nan_to_null(F.col("discount").cast("double")), F.lit(0.0))
    day = F.col("transaction_date")
    return df.withColumns(
        {
            "total_sale_amount": money(total),
            "discount_amount": discount,
            "net_sale_amount": money(round_cents(total - discount)),
            "order_year": F.year(day),
            "order_month": F.month(day),
            "order_day": F.dayofmonth(day),
            "date_id": date_key(day),
        }
    )


def build_dim_date(dates: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """One row per distinct date of ``dates``."""
    day = F.col("date")
    return (
        dates.select(F.col(date_col).cast("date").alias("date"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_id"),
            day,
            F.dayofmonth(day).alias("day"),
            F.month(day).alias("month"),
            F.quarter(day).alias("quarter"),
            F.year(day).alias("year"),
            weekday_name(day).alias("weekday"),
        )
    )


def to_dimension(df: DataFrame, table: str) -> DataFrame:
    """Warehouse columns only, in their types; helper columns fall away."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in WAREHOUSE[table].fields])


def to_fact(df: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in WAREHOUSE["fact_sales"].fields}
    return df.select(*[F.col(c).cast(kinds[c]) for c in FACT_COLUMNS])
