"""Rows that are new since the last load, and keys for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.schemas import FACT_GRAIN

FILE, FIRST_ID = "file", "first_id"


def new_dimension_rows(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not loaded yet.

    The loaded keys are cut down to those of the batch first: a small batch is broadcast to
    them, and a dimension of any size is scanned without a shuffle.
    """
    repeated = existing.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(repeated, key, "left_anti")


def date_month(date_id: str) -> Column:
    """yyyymm of a yyyymmdd column."""
    return F.expr(f"CAST({date_id} DIV 100 AS INT)")


def new_fact_rows(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose customer, product and date are not loaded yet.

    Repeats inside the batch stay. Loaded grains are made distinct first, so a grain loaded many
    times cannot weigh on one task. That step groups by the month too: the join then shuffles
    on its own, the shape in which AQE splits a hot grain of the batch.
    """
    loaded = (
        existing.groupBy(*FACT_GRAIN, date_month("date_id").alias("grain_month"))
        .agg(F.lit(1).alias("seen"))
        .select(*FACT_GRAIN)
    )
    return batch.join(loaded, FACT_GRAIN, "left_anti")


def first_ids(sizes: DataFrame, start: int) -> DataFrame:
    """(file, first_id) of (file, n): ids follow each other without gaps, in the files' order.

    The window runs over one row per file of a load, not over its rows.
    """
    before = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(FILE, (F.coalesce(F.sum("n").over(before), F.lit(0)) + start).alias(FIRST_ID))


def file_sizes(rows: DataFrame) -> DataFrame:
    """(file, n) of a written table; read from footers."""
    return rows.groupBy(F.col("_metadata.file_path").alias(FILE)).agg(F.count("*").alias("n"))


def with_ids(rows: DataFrame, firsts: DataFrame, id_column: str) -> DataFrame:
    """Rows of a written table with the id of their place: their file's first one, and their row.

    The same rows get the same ids after any retry, and any number of files and rows has room.
    """
    placed = rows.withColumns({FILE: F.col("_metadata.file_path"), "at": F.col("_metadata.row_index")})
    return placed.join(firsts, FILE).select((F.col(FIRST_ID) + F.col("at")).alias(id_column), *rows.columns)
