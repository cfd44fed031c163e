"""Cleaning and typing of staged rows."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tallymill.functions.dates import parse_day, utc_today
from tallymill.functions.numbers import nan_to_null
from tallymill.functions.text import blank_to_null, strip
from tallymill.operators.statistics import exact_median
from tallymill.session import settle

logger = logging.getLogger(__name__)

MISFIT_VALUES = "misfit_values"
# Helper columns, dropped again.
_PIECES, _WHOLE, _AMOUNT, _NET = "_pieces", "_whole_pieces", "_amount", "_net"
# Amounts are DECIMAL(18,2).
AMOUNT_LIMIT = 1e16
# Earliest signups up to this many rows are joined with all sales.
SMALL_SIGNUPS = 500_000


def normalize_blank_strings(df: DataFrame) -> DataFrame:
    """Empty or whitespace-only text becomes null, in every text column."""
    return df.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _absolute_price(column: str) -> Column:
    """Sign dropped, zero taken as missing."""
    return F.nullif(F.abs(nan_to_null(F.col(column))), F.lit(0.0))


def clean_sales_numbers(
    df: DataFrame,
    quantity_col: str = "quantity",
    price_col: str = "unit_price",
    median: float | None = None,
) -> DataFrame:
    """Whole non-negative quantities (missing is 0) and positive prices.

    A missing or zero price takes the median of the prices as delivered, signs and zeros
    included. Pass ``median`` when it is known, to save the pass that finds it. Values that their
    column cannot hold become null or stay, and are told in ``misfit_values`` as delivered, for
    the quarantine: the row is rejected later, and the others go on.
    """
    if median is None:
        median = exact_median(df, price_col)
    pieces = F.abs(F.coalesce(nan_to_null(F.col(quantity_col).cast("double")), F.lit(0.0)))
    # Zero takes the median too; the median itself may be zero or negative and is kept as is.
    price = F.coalesce(_absolute_price(price_col), F.lit(median).cast("double"))
    off = nan_to_null(F.col("discount").cast("double")) if "discount" in df.columns else F.lit(0.0)
    # Step by step, so that each value is worked out once and the texts only where one is a misfit.
    steps = (
        df.withColumns({_PIECES: pieces, price_col: price})
        .withColumn(_AMOUNT, F.col(_PIECES) * F.col(price_col))
        .withColumns({_NET: F.col(_AMOUNT) - F.coalesce(off, F.lit(0.0)), _WHOLE: F.col(_PIECES).try_cast("int")})
    )
    no_int, big, big_net = F.col(_WHOLE).isNull(), F.col(_AMOUNT) >= AMOUNT_LIMIT, F.abs(_NET) >= AMOUNT_LIMIT
    misfits = F.concat_ws(
        ";",
        F.when(no_int, _told(quantity_col, F.col(quantity_col))),
        F.when(big, _told("amount", F.col(_AMOUNT))),
        F.when(big_net, _told("net", F.col(_NET))),
    )
    cleaned = {quantity_col: F.col(_WHOLE), MISFIT_VALUES: F.when(no_int | big | big_net, misfits)}
    return steps.withColumns(cleaned).drop(_PIECES, _AMOUNT, _NET, _WHOLE)


def _told(name: str, value: Column) -> Column:
    """``name=value``, in plain digits where they are not too many."""
    plain = value.try_cast("decimal(38,2)").cast("string")
    return F.concat(F.lit(f"{name}="), F.coalesce(plain, value.cast("string")))


def clean_product_prices(
    df: DataFrame, price_col: str = "unit_price", median: float | None = None
) -> DataFrame:
    """Positive prices; missing or zero takes the median of the positive ones."""
    price = _absolute_price(price_col)
    if median is None:
        median = exact_median(df.select(price.alias(price_col)), price_col)
    return df.withColumn(price_col, F.coalesce(price, F.lit(median).cast("double")))


# --- final types: a failing number cast stops the run, a bad date becomes null ---


def _as_day(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return parse_day(F.col(column)) if isinstance(kind, StringType) else F.col(column).cast("date")


def enforce_sales_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **{c: F.col(c).cast("long") for c in ("transaction_id", "customer_id", "product_id")},
            "quantity": F.col("quantity").cast("int"),
            "unit_price": F.col("unit_price").cast("double"),
            "discount": F.col("discount").cast("double"),
            "transaction_date": _as_day(df, "transaction_date"),
            "ingest_date": F.col("ingest_date").cast("timestamp_ntz"),
        }
    )


def enforce_customer_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "customer_id": F.col("customer_id").cast("long"),
            **{c: F.col(c).cast("string") for c in ("customer_name", "email", "city", "state")},
            "signup_date": _as_day(df, "signup_date"),
            "ingest_date": F.col("ingest_date").cast("timestamp_ntz"),
        }
    )


def enforce_product_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "product_id": F.col("product_id").cast("long"),
            **{
                c: strip(F.col(c).cast("string")) for c in ("product_name", "category", "brand")
            },
            "unit_price": F.col("unit_price").cast("double"),
            "ingest_date": F.col("ingest_date").cast("timestamp_ntz"),
        }
    )


def enforce_column_types(df: DataFrame, type_map: dict[str, str], table_name: str) -> DataFrame:
    """Cast by name: ``datetime`` is lenient, any other type fails naming table and column."""
    absent = [c for c in type_map if c not in df.columns]
    if absent:
        raise ValueError(f"{table_name}: no such column {absent}")

    def cast(column: str, kind: str) -> Column:
        source = F.col(column)
        if kind == "datetime":
            return F.try_to_timestamp(source.cast("string")).cast("timestamp_ntz")
        typed = source.try_cast(kind)
        message = F.concat(
            F.lit(f"{table_name}: invalid {kind} in column '{column}': "), source.cast("string")
        )
        return F.when(source.isNull() | typed.isNotNull(), typed).otherwise(
            F.raise_error(message).cast(kind)
        )

    return df.withColumns({c: cast(c, kind) for c, kind in type_map.items()})


# --- schema check: looks at column names and types only, starts no job ---


@dataclass(frozen=True)
class Finding:
    table: str
    column: str
    kind: str  # missing, extra or type
    detail: str


def _family(kind) -> str:
    if isinstance(kind, StringType):
        return "text"
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return "datetime"
    if isinstance(kind, NumericType):
        return kind.simpleString()
    return kind.simpleString()


def schema_findings(df: DataFrame, expected: StructType, table_name: str) -> list[Finding]:
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    found = [Finding(table_name, c, "missing", "") for c in wanted if c not in actual]
    found += [Finding(table_name, c, "extra", "") for c in actual if c not in wanted]
    found += [
        Finding(table_name, c, "type", f"{_family(actual[c])}, expected {_family(kind)}")
        for c, kind in wanted.items()
        if c in actual and _family(actual[c]) != _family(kind)
    ]
    return found


def check_schema(df: DataFrame, expected: StructType, table_name: str) -> list[Finding]:
    """Missing columns stop the run; extra columns and other types are logged and returned."""
    found = schema_findings(df, expected, table_name)
    missing = [f.column for f in found if f.kind == "missing"]
    if missing:
        raise ValueError(f"{table_name}: missing required columns {missing}")
    for f in found:
        logger.warning("%s: %s column %s %s", f.table, f.kind, f.column, f.detail)
    return found


# --- imputing dates ---


def impute_transaction_dates(
    sales: DataFrame,
    customers: DataFrame,
    date_col: str = "transaction_date",
    as_of: date | None = None,
    small_rows: int = SMALL_SIGNUPS,
) -> DataFrame:
    """Missing or unreadable date: the customer's earliest signup, else ``as_of`` (today, UTC).

    Up to ``small_rows`` customers are joined with all sales, which are read once and stay where
    they are, as the planner broadcasts so few. Beyond that only rows without a date are joined:
    the sales are worked out and written once, and those with a date are not shuffled.
    """
    earliest = settle(
        customers.select("customer_id", _as_day(customers, "signup_date").alias("first_signup"))
        .where(F.col("customer_id").isNotNull() & F.col("first_signup").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("first_signup").alias("first_signup")),
        "earliest-signup",
    )
    fallback = F.lit(as_of) if as_of else utc_today()
    days = sales.withColumn(date_col, _as_day(sales, date_col))
    if earliest.count() <= small_rows:
        day = F.coalesce(date_col, "first_signup", fallback)
        return days.join(earliest, "customer_id", "left").withColumn(date_col, day).select(*sales.columns)
    days = settle(days, "sales-days")
    imputed = (
        days.where(F.col(date_col).isNull())
        .join(earliest, "customer_id", "left")
        .withColumn(date_col, F.coalesce("first_signup", fallback))
    )
    return days.where(F.col(date_col).isNotNull()).unionByName(imputed.select(*sales.columns))
