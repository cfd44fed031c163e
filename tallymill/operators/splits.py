"""Splits of sales rows into clean and rejected.

Every test is wrapped so that "unknown" counts as "not rejected": a bare ``NOT (null <= 0)``
would lose the row from both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.dates import parse_day
from tallymill.operators.cleaning import MISFIT_VALUES
from tallymill.session import in_parallel, settle

INVALID_DATE = "INVALID_DATE"
CORRUPT_VALUE = "CORRUPT_VALUE"
ORPHAN_KEY = "ORPHAN_KEY"
NULL_KEY = "NULL_KEY"
MULTI_CUSTOMER = "MULTI_CUSTOMER_TRANSACTION"

# ---- fixed values: numbers of the reject batches ----
BATCH_OF_REASON = {INVALID_DATE: 1, CORRUPT_VALUE: 2, ORPHAN_KEY: 3, NULL_KEY: 4}
# ---- end of fixed values ----

RAW_DATE = "raw_transaction_date"

# Key sets up to this many rows are joined as they are, larger ones by what they lack.
SMALL_KEY_SET = 1_000_000


def _known(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def split(df: DataFrame, rejected_when: Column) -> tuple[DataFrame, DataFrame]:
    rejected = _known(rejected_when)
    return df.where(~rejected), df.where(rejected)


def is_corrupt(df: DataFrame, date_col: str = "transaction_date") -> Column:
    """No date, quantity or price not above zero, or a value that its column cannot hold."""
    test = (
        F.col(date_col).isNull()
        | _known(F.col("quantity") <= 0)
        | _known(F.col("unit_price") <= 0)
    )
    return test | F.col(MISFIT_VALUES).isNotNull() if MISFIT_VALUES in df.columns else test


def parse_transaction_date(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Typed date in place, the delivered text kept beside it for the quarantine."""
    return df.withColumns({RAW_DATE: F.col(date_col), date_col: parse_day(F.col(date_col))})


def validate_transaction_dates(
    df: DataFrame, date_col: str = "transaction_date"
) -> tuple[DataFrame, DataFrame]:
    return split(parse_transaction_date(df, date_col), F.col(date_col).isNull())


def detect_corrupt_sales(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(df, is_corrupt(df))


def detect_multi_customer_transactions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of a transaction id that is used by more than one customer are rejected.

    min <> max finds these ids with an aggregate that combines before the shuffle; the ids are
    written, so the joins see their size and can split a transaction that holds many rows.
    """
    ids = settle(
        df.where(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.min("customer_id").alias("first"), F.max("customer_id").alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("transaction_id"),
        "multi-customer-ids",
    )
    return (
        df.join(ids, "transaction_id", "left_anti"),
        df.join(ids, "transaction_id", "left_semi"),
    )


def _key_check(
    sales: DataFrame, known: list[DataFrame], key: str, marker: str, small_rows: int
) -> tuple[DataFrame, Column]:
    """A table to left-join by ``key``, and the test that then tells rows with no known key."""
    keys = [table.select(key) for table in known]
    if sum(table.count() for table in keys) <= small_rows:
        # Few keys: the planner broadcasts them and the sales stay where they are.
        every = settle(reduce(DataFrame.unionByName, keys).distinct(), f"{key}-known")
        return every.withColumn(marker, F.lit(True)), F.col(marker).isNull()
    # Many keys: start from the distinct keys of the sales, one column, combined before its
    # shuffle. The big tables are only filtered by these. What is left over is unknown, few as a
    # rule, so joining it spares the shuffle of whole rows; where it is much, that join is split
    # like any other.
    wanted = settle(
        sales.select(key).where(F.col(key).isNotNull()).distinct(), f"{key}-wanted"
    )
    unknown = wanted
    for table in keys:
        unknown = unknown.join(table.join(wanted, key, "left_semi"), key, "left_anti")
    unknown = settle(unknown, f"{key}-unknown").withColumn(marker, F.lit(True))
    return unknown, F.col(marker).isNotNull() | F.col(key).isNull()


def mark_orphans(
    sales: DataFrame,
    customers: list[DataFrame],
    products: list[DataFrame],
    small_rows: int = SMALL_KEY_SET,
) -> DataFrame:
    """``is_orphan``: the customer or the product is missing or in none of the given tables.

    The tables are counted first, so they should be scans.
    """
    (customer_side, no_customer), (product_side, no_product) = in_parallel(
        sales.sparkSession,
        lambda: _key_check(sales, customers, "customer_id", "customer_mark", small_rows),
        lambda: _key_check(sales, products, "product_id", "product_mark", small_rows),
    )
    return (
        sales.join(customer_side, "customer_id", "left")
        .join(product_side, "product_id", "left")
        .select(*sales.columns, (no_customer | no_product).alias("is_orphan"))
    )


def detect_orphan_sales(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    small_rows: int = SMALL_KEY_SET,
) -> tuple[DataFrame, DataFrame]:
    marked = mark_orphans(sales, [customers], [products], small_rows)
    clean, rejected = split(marked, F.col("is_orphan"))
    return clean.drop("is_orphan"), rejected.drop("is_orphan")


def classify_sales(
    sales: DataFrame,
    customers: list[DataFrame],
    products: list[DataFrame],
    small_rows: int = SMALL_KEY_SET,
) -> DataFrame:
    """``reject_reason`` of the first test a row fails: date, values, missing ids, unknown ids.

    Expects cleaned numbers and dates parsed by ``parse_transaction_date``. One pass over the
    sales gives both sides.
    """
    any_null_key = (
        F.col("transaction_id").isNull()
        | F.col("customer_id").isNull()
        | F.col("product_id").isNull()
    )
    reason = (
        F.when(F.col("transaction_date").isNull(), INVALID_DATE)
        .when(is_corrupt(sales), CORRUPT_VALUE)
        .when(any_null_key, NULL_KEY)
        .when(F.col("is_orphan"), ORPHAN_KEY)
    )
    return (
        mark_orphans(sales, customers, products, small_rows)
        .withColumn("reject_reason", reason)
        .drop("is_orphan")
    )


def batch_number(reason: Column) -> Column:
    number = F.lit(None).cast("int")
    for name, index in BATCH_OF_REASON.items():
        number = F.when(reason == name, F.lit(index)).otherwise(number)
    return number
