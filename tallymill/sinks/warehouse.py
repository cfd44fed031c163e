"""Warehouse tables: insert-only dimensions and an incremental fact split by month.

Rows are written under their load's number and count once that is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators.incremental import (
    date_month,
    file_sizes,
    first_ids,
    new_dimension_rows,
    new_fact_rows,
    with_ids,
)
from tallymill.operators.shaping import to_dimension, to_fact
from tallymill.schemas import DIMENSION_KEYS, FACT_COLUMNS, WAREHOUSE
from tallymill.session import settle, write_own_folders
from tallymill.sinks.publication import LOAD, Snapshot, of_load
from tallymill.sources.markers import make_folder
from tallymill.sources.tables import (
    FACT_PARTITION,
    read_dimension_keys,
    read_fact_grain,
)


def create_tables(spark: SparkSession, warehouse: str) -> None:
    """Folders of the tables, which are empty where there is nothing yet."""
    for name in WAREHOUSE:
        make_folder(spark, f"{warehouse}/{name}")


def load_dimension(
    spark: SparkSession, warehouse: str, df: DataFrame, table: str, snapshot: Snapshot, load: int
) -> None:
    """Write the rows whose key is not there yet; loaded rows are never changed."""
    key = DIMENSION_KEYS[table]
    batch = to_dimension(df, table)
    delta = new_dimension_rows(batch, read_dimension_keys(spark, warehouse, table, snapshot), key)
    # Rebalanced, so a small delta does not leave one tiny file per shuffle partition.
    rows = of_load(delta.hint("rebalance"), load)
    write_own_folders(rows, f"{warehouse}/{table}", LOAD)


def fact_days(facts: DataFrame) -> list[int]:
    """Date keys of the batch: at most the days of the calendar."""
    return [row["date_id"] for row in facts.select("date_id").distinct().collect()]


def load_fact(
    spark: SparkSession,
    warehouse: str,
    df: DataFrame,
    days: list[int],
    snapshot: Snapshot,
    load: int,
) -> int:
    """Write the rows whose grain is not there yet; returns how many.

    Of the loaded fact, only the grain columns of the batch's days are read. The new rows are
    written aside first: their number and places then give them ids without gaps. Rows are sorted
    by day within their month, so that later loads can skip what they do not need.
    """
    if not days:
        return 0
    batch = to_fact(df).withColumn(FACT_PARTITION, date_month("date_id"))
    delta = new_fact_rows(batch, read_fact_grain(spark, warehouse, days, snapshot))
    delta = settle(delta.hint("rebalance", F.col(FACT_PARTITION)), "fact-delta")
    sizes = settle(file_sizes(delta), "fact-sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    firsts = settle(first_ids(sizes, snapshot.next_sales_id), "fact-first-ids")
    rows = (
        of_load(with_ids(delta, firsts, "sales_id"), load)
        .select("sales_id", *FACT_COLUMNS, FACT_PARTITION, LOAD)
        .sortWithinPartitions(FACT_PARTITION, "date_id")
    )
    write_own_folders(rows, f"{warehouse}/fact_sales", FACT_PARTITION, LOAD)
    return total
