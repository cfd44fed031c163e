"""Keeping the best row per key and setting the others aside.

The winner of a key is found by ``max`` of a struct, an aggregate that is combined before the
shuffle, so a key that holds a third of all rows sends one row per map task. The winners are
written once (they are the clean table anyway). To find the losers, rows are joined with the
winners of contested keys only: few as a rule, so they are broadcast and the rows stay where they
are; where they are many, AQE splits a hot key over many tasks. A ``row_number`` over the key
would put all of a hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.dates import parse_day
from tallymill.functions.text import is_valid_product_name, strip
from tallymill.session import settle

ROW_ID = "row_id"
ROWS_OF_KEY = "rows_of_key"
HELPERS = (ROW_ID, ROWS_OF_KEY)
NULL_KEY = "NULL_KEY"
DUPLICATE_CUSTOMER = "DUPLICATE_CUSTOMER_ID"

# ---- fixed values: reject reasons of products ----
INVALID_PRODUCT_NAME = "INVALID_PRODUCT_NAME"
DUPLICATE_PRODUCT_ID = "DUPLICATE_PRODUCT_ID"
# ---- end of fixed values ----


def file_row_id() -> Column:
    """Identity of a Parquet row: its file and its place there. The same after any retry."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def with_row_id(df: DataFrame, name: str = "rows") -> DataFrame:
    """Ensure a stable row identity; rows that have none are written once to get theirs."""
    if ROW_ID in df.columns:
        return df
    written = settle(df, name)
    return written.select("*", file_row_id().alias(ROW_ID))


def best_per_key(df: DataFrame, key: str, ranking: list[Column]) -> DataFrame:
    """One whole row per non-null key: highest by ``ranking``, nulls last; and its row count.

    Ties go by the remaining columns, then by row identity, so any run picks the same row.
    """
    rest = [c for c in df.columns if c not in (key, ROW_ID)]
    order = F.struct(
        *[column.alias(f"by{i}") for i, column in enumerate(ranking)],
        F.struct(*rest).alias("row"),
        F.col(ROW_ID),
    )
    best = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(order).alias("best"), F.count("*").alias(ROWS_OF_KEY))
    )
    return best.select(key, "best.row.*", f"best.{ROW_ID}", ROWS_OF_KEY)


def _rejected(rows: DataFrame, winners: DataFrame, key: str, reason: Column) -> DataFrame:
    """Rows with a reason, given the winners (as ``best_id`` and such) that decide about them."""
    winners = settle(winners, f"{key}-contested")
    return (
        rows.join(winners, key, "left")
        .withColumn("reject_reason", F.when(F.col(key).isNull(), NULL_KEY).otherwise(reason))
        .where(F.col("reject_reason").isNotNull())
        .drop(ROW_ID, *[c for c in winners.columns if c != key])
    )


# --- customers: the latest readable signup wins ---


def prepare_customers(df: DataFrame) -> DataFrame:
    return with_row_id(df.withColumn("signup_date", parse_day(F.col("signup_date"))), "customers")


def best_customers(prepared: DataFrame) -> DataFrame:
    return best_per_key(prepared, "customer_id", [F.col("signup_date")])


def rejected_customers(prepared: DataFrame, best: DataFrame) -> DataFrame:
    contested = best.where(F.col(ROWS_OF_KEY) > 1)
    return _rejected(
        prepared,
        contested.select("customer_id", F.col(ROW_ID).alias("best_id")),
        "customer_id",
        F.when(F.col(ROW_ID) != F.col("best_id"), DUPLICATE_CUSTOMER),
    )


def resolve_duplicate_customers(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per customer, all other rows with a reason)."""
    prepared = prepare_customers(df)
    best = settle(best_customers(prepared), "customers-best")
    return best.select(*_original(df)), rejected_customers(prepared, best)


# --- products: a valid name first, then the most complete row ---


def prepare_products(df: DataFrame) -> DataFrame:
    named = df.withColumn("product_name", strip(F.col("product_name")))
    return with_row_id(
        named.withColumn("is_valid_name", is_valid_product_name(F.col("product_name"))),
        "products",
    )


def best_products(prepared: DataFrame) -> DataFrame:
    """Best row per product id, also where no name is valid: callers filter ``is_valid_name``."""
    return best_per_key(
        prepared,
        "product_id",
        [
            F.col("is_valid_name"),
            F.coalesce(F.col("unit_price"), F.lit(0.0)) > 0,
            F.col("category").isNotNull(),
            F.col("brand").isNotNull(),
            F.col("unit_price"),
        ],
    )


def rejected_products(prepared: DataFrame, best: DataFrame) -> DataFrame:
    contested = best.where((F.col(ROWS_OF_KEY) > 1) | ~F.col("is_valid_name"))
    return _rejected(
        prepared,
        contested.select(
            "product_id",
            F.col(ROW_ID).alias("best_id"),
            F.col("is_valid_name").alias("any_valid_name"),
        ),
        "product_id",
        F.when(~F.col("any_valid_name"), INVALID_PRODUCT_NAME).when(
            F.col(ROW_ID) != F.col("best_id"), DUPLICATE_PRODUCT_ID
        ),
    )


def resolve_duplicate_products(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one validly named row per product, all other rows with a reason)."""
    prepared = prepare_products(df)
    best = settle(best_products(prepared), "products-best")
    clean = best.where("is_valid_name").select(*_original(df), "is_valid_name")
    return clean, rejected_products(prepared, best)


def _original(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_ID]


# --- listing duplicated keys ---


def duplicated_keys(df: DataFrame, keys: list[str], count_name: str) -> DataFrame:
    """Keys held by more than one row, with their row count; null keys are not counted."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return (
        df.where(present)
        .groupBy(*keys)
        .agg(F.count("*").alias(count_name))
        .where(F.col(count_name) > 1)
    )


def rows_with_duplicated_key(df: DataFrame, key: str) -> DataFrame:
    """Whole rows of every duplicated key."""
    repeated = settle(duplicated_keys(df, [key], "n").select(key), f"repeated-{key}")
    return df.join(repeated, key, "left_semi")
