"""Audit log: one row per pipeline, upserted; beside it, in the same form, one row per feed.

Plain Parquet has no MERGE. Each upsert writes the whole small table as a new version; readers
take the newest, so a failed write leaves the last one in force and nothing is overwritten.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallymill.schemas import AUDIT, STAGING
from tallymill.sources.markers import create_once
from tallymill.sources.tables import empty_table, path_exists, read_table, single_row

# ---- fixed values ----
PIPELINE_NAME = "sales_etl"
FIRST_WATERMARK = datetime(1900, 1, 1)
SUCCESS = "SUCCESS"
FAILED = "FAILED"
# ---- end of fixed values ----

_VERSIONED = StructType([*AUDIT.fields, StructField("version", IntegerType(), True)])


def upsert(existing: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``existing`` with the rows of ``changes`` put in the place of those with the same key."""
    return existing.join(changes.select(key), key, "left_anti").unionByName(changes)


def _versions(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    if not path_exists(spark, path):
        return empty_table(spark, _VERSIONED), 0
    table = read_table(spark, path, _VERSIONED)
    return table, table.agg(F.max("version")).first()[0] or 0


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    table, newest = _versions(spark, path)
    return table.where(F.col("version") == newest).select(*AUDIT.fieldNames())


def write_audit(spark: SparkSession, path: str, changes: DataFrame) -> None:
    table, newest = _versions(spark, path)
    current = table.where(F.col("version") == newest).select(*AUDIT.fieldNames())
    number = newest + 1
    # Two writers never share a version's folder; a claim that is not used leaves a gap.
    while not create_once(spark, f"{path}/_claims/{number}"):
        number += 1
    upsert(current, changes.select(*AUDIT.fieldNames()), "pipeline_name").coalesce(1).write.mode(
        "errorifexists"
    ).parquet(f"{path}/version={number}")


def last_watermark(
    spark: SparkSession, path: str, pipeline_name: str = PIPELINE_NAME
) -> datetime:
    row = (
        read_audit(spark, path)
        .where(F.col("pipeline_name") == pipeline_name)
        .select("last_processed_ingest_date")
        .first()
    )
    return row[0] if row and row[0] else FIRST_WATERMARK


def feed_watermarks(spark: SparkSession, path: str, otherwise: datetime) -> dict[str, datetime]:
    """Each feed's newest loaded row. Feeds are staged on their own, so a late one may be stamped
    before another's newest row. ``otherwise`` holds for feeds without a row of their own."""
    rows = read_audit(spark, path).select("pipeline_name", "last_processed_ingest_date").collect()
    known = {name: newest for name, newest in rows if newest}
    return {feed: known.get(feed, otherwise) for feed in STAGING}


def record_feeds(
    spark: SparkSession, path: str, watermarks: dict[str, datetime], counts: dict[str, int]
) -> None:
    """Set all feeds' watermarks and extracted rows, in one write."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    rows = [
        single_row(
            spark,
            AUDIT,
            pipeline_name=feed,
            last_processed_ingest_date=newest.isoformat(" "),
            records_processed=counts[feed],
            records_rejected=None,
            records_loaded=None,
            run_status=SUCCESS,
            updated_at=None,
        )
        for feed, newest in watermarks.items()
    ]
    write_audit(spark, path, reduce(DataFrame.unionByName, rows).withColumn("updated_at", now))


def record_run(
    spark: SparkSession,
    path: str,
    watermark: datetime,
    processed: int,
    rejected: int,
    loaded: int,
    status: str = SUCCESS,
    pipeline_name: str = PIPELINE_NAME,
) -> None:
    """Set the pipeline's counts, status and watermark. A failed run passes the old watermark."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    row = single_row(
        spark,
        AUDIT,
        pipeline_name=pipeline_name,
        last_processed_ingest_date=watermark.isoformat(" "),
        records_processed=processed,
        records_rejected=rejected,
        records_loaded=loaded,
        run_status=status,
        updated_at=None,
    )
    write_audit(spark, path, row.withColumn("updated_at", now))
