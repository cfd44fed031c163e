"""Staging: batches of delivered rows, each published by one marker.

``<staging>/<table>/row_status=ok|corrupt/ingest_day=<day>/batch=<name>`` holds the rows,
``<staging>/<table>/_commits/ingest_day=<day>/<name>`` says that they count, and
``<staging>/<table>_files`` says what became of each delivered file. Readers go by the markers of
the days they need; rows without one are never seen, so a batch that died half way or is replayed
adds nothing twice.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.schemas import STAGING
from tallymill.session import write_own_folders
from tallymill.sources.markers import create_once, read_marker
from tallymill.sources.tables import (
    BATCH,
    CORRUPT_TEXT,
    FILE_ACCOUNTS,
    ROW_CORRUPT,
    ROW_OK,
    SOURCE_FILE,
    commit_path,
    drop_folder,
    empty_table,
    folder_names,
    path_exists,
    published_batches,
    read_batches,
)

# ---- fixed values ----
#: Day of rows without a stamp: before any watermark, so that no increment takes them.
UNDATED = date(1900, 1, 1)
# ---- end of fixed values ----

STAGED = "STAGED"


def is_published(spark: SparkSession, staging: str, table: str, day: date, batch: str) -> bool:
    return read_marker(spark, commit_path(staging, table, day, batch)) is not None


def publish_batch(
    staging: str, table: str, batch: str, day: date, rows: DataFrame, verdicts: DataFrame | None = None
) -> bool:
    """Write a day's rows of a batch and publish them; False if that was done before.

    ``rows`` have the staging columns, ``corrupt_text`` and ``source_file``; ``verdicts`` have
    ``file_name``, ``verdict`` and ``detail`` of every delivered file. Leftovers of an attempt
    that was not published are replaced.
    """
    spark = rows.sparkSession
    if is_published(spark, staging, table, day, batch):
        return False
    path = f"{staging}/{table}"
    placed = rows.select(*STAGING[table].fieldNames(), CORRUPT_TEXT, SOURCE_FILE).withColumns(
        {
            "row_status": F.when(F.col(CORRUPT_TEXT).isNull(), ROW_OK).otherwise(ROW_CORRUPT),
            "ingest_day": F.lit(day),
            BATCH: F.lit(batch),
        }
    )
    write_own_folders(placed, path, "row_status", "ingest_day", BATCH)
    _write_accounts(spark, staging, table, batch, day, verdicts)
    return create_once(spark, commit_path(staging, table, day, batch))


def _write_accounts(
    spark: SparkSession, staging: str, table: str, batch: str, day: date, verdicts: DataFrame | None
) -> None:
    """Rows per delivered file, counted in what was written."""
    folders = [f"row_status={s}/ingest_day={day}/{BATCH}={batch}" for s in (ROW_OK, ROW_CORRUPT)]
    present = [f for f in folders if path_exists(spark, f"{staging}/{table}/{f}")]
    counts = (
        read_batches(spark, staging, table, present)
        .groupBy(F.col(SOURCE_FILE).alias("file_name"))
        .agg(
            F.count("*").alias("delivered"),
            F.count_if(F.col("row_status") == ROW_CORRUPT).alias("misfit"),
        )
    )
    if verdicts is None:
        told = counts.select("*", F.lit(STAGED).alias("verdict"), F.lit(None).cast("string").alias("detail"))
    else:
        none = F.when(F.col("verdict") == STAGED, 0).cast("long")  # a file of a header alone
        told = verdicts.join(counts, "file_name", "left").withColumns(
            {c: F.coalesce(c, none) for c in ("delivered", "misfit")}
        )
    rows = told.withColumns({"ingest_day": F.lit(day), BATCH: F.lit(batch)})
    write_own_folders(
        rows.select(*FILE_ACCOUNTS.fieldNames()), f"{staging}/{table}_files", "ingest_day", BATCH
    )


def append_batch(df: DataFrame, staging: str, table: str, batch: str) -> None:
    """Append rows that already carry their stamps; a repeated batch name adds nothing.

    The rows are worked out once: all days are written together, and those that got rows are listed
    by their folders, as many as the calendar has at most.
    """
    spark, path = df.sparkSession, f"{staging}/{table}"
    own_file = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.lit(None).cast("string")
    day = F.coalesce(F.to_date("ingest_date"), F.lit(UNDATED))
    published = {d for d, name in published_batches(spark, staging, table) if name == batch}
    for leftover in _day_folders(spark, path, batch) - published:
        drop_folder(spark, f"{path}/row_status={ROW_OK}/{leftover}/{BATCH}={batch}")
        drop_folder(spark, f"{path}/row_status={ROW_CORRUPT}/{leftover}/{BATCH}={batch}")
    rows = df.select(
        *STAGING[table].fieldNames(),
        F.lit(None).cast("string").alias(CORRUPT_TEXT),
        own_file.alias(SOURCE_FILE),
        F.lit(ROW_OK).alias("row_status"),
        day.alias("ingest_day"),
        F.lit(batch).alias(BATCH),
    )
    if published:
        days = [_day_of(folder) for folder in published]
        rows = rows.where(~F.col("ingest_day").isin(days))
    write_own_folders(rows, path, "row_status", "ingest_day", BATCH)
    for own_day in sorted(_day_of(folder) for folder in _day_folders(spark, path, batch) - published):
        _write_accounts(spark, staging, table, batch, own_day, None)
        create_once(spark, commit_path(staging, table, own_day, batch))


def _day_of(folder: str) -> date:
    return date.fromisoformat(folder.removeprefix("ingest_day="))


def _day_folders(spark: SparkSession, path: str, batch: str) -> set[str]:
    """Days that have a folder of the batch, published or not."""
    found = set()
    for status in (ROW_OK, ROW_CORRUPT):
        of_status = f"{path}/row_status={status}"
        for day in folder_names(spark, of_status):
            if path_exists(spark, f"{of_status}/{day}/{BATCH}={batch}"):
                found.add(day)
    return found


def no_rows(spark: SparkSession, table: str) -> DataFrame:
    """Rows as ``publish_batch`` takes them, none of them."""
    none = F.lit(None).cast("string")
    return empty_table(spark, STAGING[table]).withColumns({CORRUPT_TEXT: none, SOURCE_FILE: none})
