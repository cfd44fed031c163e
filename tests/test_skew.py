"""Joins against a hot key, held by a third of all rows, are split over tasks."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tallymill.operators.cleaning import impute_transaction_dates
from tallymill.operators.duplicates import (
    file_row_id,
    resolve_duplicate_customers,
    resolve_duplicate_products,
    rows_with_duplicated_key,
)
from tallymill.operators.incremental import new_fact_rows
from tallymill.operators.splits import (
    detect_multi_customer_transactions,
    detect_orphan_sales,
)

ROWS = 30_000


@contextlib.contextmanager
def small_thresholds(spark):
    """What counts as a big partition at this size; no broadcasts."""
    wanted = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sales(spark):
    """The first third of the rows share all their keys."""
    i = F.col("id")

    def key(shift):
        return F.when(i < ROWS // 3, F.lit(7)).otherwise(i + shift).cast("long")

    return spark.range(0, ROWS, 1, 8).select(
        key(0).alias("transaction_id"),
        key(100).alias("customer_id"),
        key(200).alias("product_id"),
        F.when(i % 2 == 0, "2024-01-05").alias("transaction_date"),
        F.concat(F.lit("payload "), F.sha2(i.cast("string"), 256)).alias("payload"),
    )


def test_orphans(spark, sales):
    customers = sales.select("customer_id").distinct()
    products = sales.where("product_id % 5 <> 0").select("product_id").distinct()
    with small_thresholds(spark):
        clean, rejected = detect_orphan_sales(sales, customers, products)
        plan = executed(clean)
        assert plan.split("Initial Plan")[0].count("skew=true") == 2
        assert clean.count() + rejected.count() == ROWS


def test_many_known_keys_spare_the_shuffle_of_the_sales(spark, sales):
    """Key sets too big to broadcast: only distinct keys are shuffled, the unknown ones broadcast."""
    customers = sales.where("customer_id <> 20000").select("customer_id").distinct()
    products = sales.where("product_id <> 20000").select("product_id").distinct()
    clean, rejected = detect_orphan_sales(sales, customers, products, small_rows=1000)
    plan = executed(clean)
    assert plan.split("Initial Plan")[0].count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in plan
    assert (clean.count(), rejected.count()) == (ROWS - 2, 2)


def test_imputed_dates(spark, sales):
    customers = sales.select("customer_id", F.lit("2020-01-01").alias("signup_date"))
    with small_thresholds(spark):
        for small_rows in (0, ROWS):
            imputed = impute_transaction_dates(sales, customers, small_rows=small_rows)
            assert "skew=true" in executed(imputed)
            assert imputed.count() == ROWS


def test_listing_duplicates(spark, sales):
    with small_thresholds(spark):
        listed = rows_with_duplicated_key(sales, "transaction_id")
        assert "skew=true" in executed(listed)
        assert listed.count() == ROWS // 3


def test_multi_customer_transactions(spark, sales):
    mixed = sales.withColumn(
        "customer_id", F.when(F.col("transaction_id") == 7, F.crc32("payload")).otherwise(1)
    )
    with small_thresholds(spark):
        clean, rejected = detect_multi_customer_transactions(mixed)
        assert "skew=true" in executed(rejected)
        assert "skew=true" in executed(clean)
        assert (clean.count(), rejected.count()) == (ROWS - ROWS // 3, ROWS // 3)


def test_products(spark, sales):
    products = sales.select(
        "product_id",
        F.col("payload").alias("product_name"),
        F.lit("a").alias("category"),
        F.lit("b").alias("brand"),
        F.lit(1.0).alias("unit_price"),
    )
    with small_thresholds(spark):
        clean, rejected = resolve_duplicate_products(products)
        assert "skew=true" in executed(rejected)
        assert (clean.count(), rejected.count()) == (ROWS - ROWS // 3 + 1, ROWS // 3 - 1)


def test_few_contested_keys_spare_the_shuffle(spark, sales, folder):
    """One contested key, a third of all rows: the join that finds its losers shuffles nothing."""
    sales.select("customer_id", F.col("payload").alias("customer_name"), F.lit("2020-01-01").alias("signup_date")).write.parquet(f"{folder}/c")
    rows = spark.read.parquet(f"{folder}/c").select("*", file_row_id().alias("row_id"))
    clean, rejected = resolve_duplicate_customers(rows)
    plan = executed(rejected)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert (clean.count(), rejected.count()) == (ROWS - ROWS // 3 + 1, ROWS // 3 - 1)


def test_null_keys(spark, sales):
    """A third of the rows without a key."""
    rows = sales.select(
        F.nullif("customer_id", F.lit(7)).alias("customer_id"),
        F.col("payload").alias("customer_name"),
        F.lit("2020-01-01").alias("signup_date"),
    )
    with small_thresholds(spark):
        clean, rejected = resolve_duplicate_customers(rows)
        assert (clean.count(), rejected.count()) == (ROWS - ROWS // 3, ROWS // 3)


@pytest.mark.parametrize("loaded_too", [False, True])
def test_new_fact_rows(spark, sales, loaded_too):
    """Hot in the batch, and hot on both sides."""
    facts = sales.withColumn("date_id", F.lit(20240101)).drop("transaction_date")
    loaded = facts if loaded_too else facts.where("customer_id % 2 = 1 AND customer_id <> 7")
    loaded = loaded.where("customer_id % 3 <> 0")
    with small_thresholds(spark):
        new = new_fact_rows(facts, loaded)
        plan = executed(new)
        assert "skew=true" in plan
        expected = facts.join(
            loaded.select("customer_id").distinct(), "customer_id", "left_anti"
        ).count()
        assert new.count() == expected > 0
