"""Data checks: of the warehouse, of staging, and profiles of rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymill.functions.dates import PLAIN_FORMATS, day_format, looks_like_iso_date, parse_day
from tallymill.functions.numbers import money
from tallymill.functions.text import blank_to_null
from tallymill.operators.cleaning import schema_findings
from tallymill.operators.duplicates import duplicated_keys, rows_with_duplicated_key
from tallymill.plans.star import Star
from tallymill.schemas import DIMENSION_KEYS, FACT_GRAIN

# --- warehouse ---


def orphan_count(fact: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Fact rows whose key is not in the dimension; a missing key counts.

    Rows are counted per key first: the join then sees each key once, so no key is hot.
    """
    return (
        fact.groupBy(key)
        .agg(F.count("*").alias("n"))
        .join(dimension.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(name))
    )


def orphan_fact_customers(star: Star) -> DataFrame:
    return orphan_count(star.fact_sales, star.dim_customer, "customer_id", "orphan_customers")


def orphan_fact_products(star: Star) -> DataFrame:
    return orphan_count(star.fact_sales, star.dim_product, "product_id", "orphan_products")


def orphan_fact_dates(star: Star) -> DataFrame:
    return orphan_count(star.fact_sales, star.dim_date, "date_id", "orphan_dates")


def duplicate_fact_grain(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(*FACT_GRAIN)
        .agg(F.count("*").alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
    )


def line_total_mismatch(fact: DataFrame) -> DataFrame:
    """Rows whose stored total is not quantity times the price in cents."""
    expected = F.col("quantity") * money(F.col("unit_price"))
    return fact.where(money(F.col("total_sale_amount")) != expected)


def total_reconciliation(fact: DataFrame) -> DataFrame:
    line = (F.col("quantity") * F.col("unit_price")).cast("decimal(28,6)")
    return fact.agg(
        F.round(F.sum(line), 2).alias("recomputed_total"),
        F.sum(money(F.col("total_sale_amount"))).alias("stored_total"),
    )


def discount_sanity(fact: DataFrame) -> DataFrame:
    net, total = F.col("net_sale_amount"), F.col("total_sale_amount")
    return fact.where((net > total) | (net < 0))


def _dimensions(star: Star) -> dict[str, DataFrame]:
    return {name: getattr(star, name) for name in DIMENSION_KEYS}


def not_null_violations(star: Star) -> DataFrame:
    """Rows without a key, per dimension."""
    parts = [
        table.agg(F.count_if(F.col(DIMENSION_KEYS[name]).isNull()).alias("violations")).select(
            F.lit(name).alias("table_name"), "violations"
        )
        for name, table in _dimensions(star).items()
    ]
    return reduce(DataFrame.unionAll, parts)


def unique_violations(star: Star) -> DataFrame:
    """Dimension keys that occur more than once."""
    parts = [
        duplicated_keys(table, [DIMENSION_KEYS[name]], "occurrences").select(
            F.lit(name).alias("table_name"),
            F.col(DIMENSION_KEYS[name]).cast("long").alias("key"),
            "occurrences",
        )
        for name, table in _dimensions(star).items()
    ]
    return reduce(DataFrame.unionAll, parts)


def constraint_violations(new: Star, loaded: Star) -> DataFrame:
    """What would break if the rows of ``new`` were added to ``loaded``, counted per constraint:
    dimension rows without a key, dimension keys that repeat in ``new`` or are loaded already, fact
    rows without a key, and fact rows whose key is in no dimension of either.

    Of the loaded dimensions, only the keys are read, and cut down to those of ``new`` first.
    """

    def told(df: DataFrame, table: str, constraint: str) -> DataFrame:
        return df.select(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"), "violations")

    fact, old, parts = new.fact_sales, _dimensions(loaded), []
    for name, rows in _dimensions(new).items():
        key = DIMENSION_KEYS[name]
        parts.append(told(rows.agg(F.count_if(F.col(key).isNull()).alias("violations")), name, f"{key} NOT NULL"))
        keys = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        again = old[name].select(key).join(keys.select(key), key, "left_semi").distinct().withColumn("again", F.lit(True))
        repeated = (F.col("n") > 1) | F.col("again").isNotNull()
        found = keys.join(again, key, "left").agg(F.count_if(repeated).alias("violations"))
        parts.append(told(found, name, f"{key} UNIQUE"))
        absent = fact.agg(F.count_if(F.col(key).isNull()).alias("violations"))
        parts.append(told(absent, "fact_sales", f"{key} NOT NULL"))
        # Keys are counted before they meet the dimension, so none is hot.
        used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        known = rows.select(key).unionByName(old[name].select(key).join(used, key, "left_semi"))
        orphans = used.join(known, key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        parts.append(told(orphans, "fact_sales", f"{key} REFERENCES {name}"))
    return reduce(DataFrame.unionAll, parts)


# --- staging ---


def total_order(df: DataFrame, *first: str) -> DataFrame:
    """Global order by the given columns, nulls last, the other columns breaking ties.

    With all columns and the reading task in the sort key, range partitioning can split a hot
    value, copies of one row included.
    """
    rest = [c for c in df.columns if c not in first]
    return (
        df.withColumn("_task", F.spark_partition_id())
        .orderBy(*[F.asc_nulls_last(c) for c in (*first, *rest)], "_task")
        .drop("_task")
    )


def duplicate_customers(customers: DataFrame) -> DataFrame:
    rows = rows_with_duplicated_key(customers, "customer_id")
    return total_order(rows, "customer_id", "signup_date")


def duplicate_products(products: DataFrame) -> DataFrame:
    return total_order(rows_with_duplicated_key(products, "product_id"), "product_id")


def sales_by_transaction(sales: DataFrame) -> DataFrame:
    return total_order(sales, "transaction_id")


def duplicate_transactions(sales: DataFrame) -> DataFrame:
    return duplicated_keys(sales, ["transaction_id"], "duplicate_tran").orderBy("transaction_id")


def malformed_dates(sales: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Missing, or not shaped like yyyy-mm-dd."""
    return sales.where(F.col(date_col).isNull() | ~looks_like_iso_date(F.col(date_col)))


def schema_report(frames: dict[str, tuple[DataFrame, StructType]]) -> DataFrame:
    """Every expected or present column: what the schema check says, and its missing values."""
    parts = []
    for table, (df, expected) in frames.items():
        said = {f.column: f.kind for f in schema_findings(df, expected, table)}
        names = [*expected.fieldNames(), *[c for c in df.columns if c not in expected.names]]
        nulls = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(said.get(c, "ok")).alias("finding"),
                (
                    F.count_if(F.col(c).isNull()) if c in df.columns else F.count(F.lit(1))
                ).alias("null_count"),
            )
            for c in names
        ]
        parts.append(
            df.agg(F.array(*nulls).alias("columns"))
            .select(F.lit(table).alias("table_name"), F.explode("columns").alias("c"))
            .select("table_name", "c.*")
        )
    return reduce(DataFrame.unionAll, parts)


# --- rejected rows ---

# ---- fixed values ----
DATE_NULL = "NULL"
DATE_EMPTY = "EMPTY"
DATE_INVALID = "INVALID_DATE"
# ---- end of fixed values ----


def date_issue(date_text: Column, last_wins: bool = False) -> Column:
    """Why a delivered date is unusable, null for a good one.

    ``last_wins`` gives every bad date the most general reason; otherwise the most exact one.
    """
    bad = parse_day(date_text).isNull()
    if last_wins:
        return F.when(bad, DATE_INVALID)
    return (
        F.when(date_text.isNull(), DATE_NULL)
        .when(blank_to_null(date_text).isNull(), DATE_EMPTY)
        .when(bad, DATE_INVALID)
    )


def split_by_date_issue(
    sales: DataFrame, date_col: str = "transaction_date", last_wins: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(bad, good) rows."""
    tagged = sales.withColumn("date_issue_reason", date_issue(F.col(date_col), last_wins))
    reason = F.col("date_issue_reason")
    return tagged.where(reason.isNotNull()), tagged.where(reason.isNull())


def date_issue_profile(sales: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """One row of counts, in one pass that parses each date once."""
    issue = F.col("issue")
    return sales.select(date_issue(F.col(date_col)).alias("issue")).agg(
        F.count("*").alias("total_records"),
        F.count(issue).alias("bad_dates"),
        F.count_if(issue.isNull()).alias("good_dates"),
        F.count_if(issue == DATE_NULL).alias("null_dates"),
        F.count_if(issue == DATE_EMPTY).alias("empty_dates"),
        F.count_if(issue == DATE_INVALID).alias("invalid_dates"),
    )


def date_format_profile(
    df: DataFrame, date_col: str = "transaction_date", formats: Sequence[str] = PLAIN_FORMATS
) -> DataFrame:
    """How many dates were delivered in each format; those that none reads are ``unread``."""
    name = F.coalesce(day_format(F.col(date_col), formats), F.lit("unread"))
    return df.groupBy(name.alias("date_format")).agg(F.count("*").alias("dates"))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def rows_equal_to_token(df: DataFrame, column: str, token: str = "NaT") -> DataFrame:
    """Rows whose text is a written-out null. Exports leave nulls blank, so usually none."""
    return df.where(F.col(column) == token)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns) of a frame."""
    return df.count(), len(df.columns)
