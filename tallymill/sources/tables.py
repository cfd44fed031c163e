"""Parquet tables of staging and warehouse.

Layout: ``<staging>/<table>/row_status=ok|corrupt/ingest_day=.../batch=...`` and
``<warehouse>/<table>/load=...``, the fact split by ``date_month`` first. Increments open the
folders of the batches that were published on their days and list no others.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tallymill.operators.duplicates import ROW_ID, file_row_id
from tallymill.schemas import DIMENSION_KEYS, FACT_GRAIN, STAGING, WAREHOUSE
from tallymill.sinks.publication import LOAD, Snapshot, read_snapshot
from tallymill.sources.markers import marker_names

ROW_OK = "ok"
ROW_CORRUPT = "corrupt"
CORRUPT_TEXT = "corrupt_text"
SOURCE_FILE = "source_file"
BATCH = "batch"
FACT_PARTITION = "date_month"
# A list of days longer than this makes the plan heavy; the months are filter enough then.
LISTED_DAYS = 1000

STAGING_LAYOUT = {
    name: StructType(
        [
            *table.fields,
            StructField(CORRUPT_TEXT, StringType(), True),
            StructField(SOURCE_FILE, StringType(), True),
            StructField("row_status", StringType(), True),
            StructField("ingest_day", DateType(), True),
            StructField(BATCH, StringType(), True),
        ]
    )
    for name, table in STAGING.items()
}

FILE_ACCOUNTS = StructType(
    [
        StructField("file_name", StringType(), True),
        StructField("verdict", StringType(), True),
        StructField("detail", StringType(), True),
        StructField("delivered", LongType(), True),
        StructField("misfit", LongType(), True),
        StructField("ingest_day", DateType(), True),
        StructField(BATCH, StringType(), True),
    ]
)

_LOADED = StructField(LOAD, IntegerType(), True)
_MONTH = StructField(FACT_PARTITION, IntegerType(), True)
WAREHOUSE_LAYOUT = {
    name: StructType([*table.fields, *([_MONTH] if name == "fact_sales" else []), _LOADED])
    for name, table in WAREHOUSE.items()
}


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def single_row(spark: SparkSession, schema: StructType, **values) -> DataFrame:
    """One row of literals; starts no Python worker, as a frame made of Python rows would."""
    return spark.range(1).select(
        *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema]
    )


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan of a Parquet folder with a given schema; a folder that is not there yet is empty."""
    if not path_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())


def read_folders(
    spark: SparkSession, path: str, schema: StructType, folders: list[str]
) -> DataFrame:
    """Some partition folders of a table. Unlike a filter, this spares listing all other files."""
    if not folders:
        return empty_table(spark, schema)
    paths = [f"{path}/{folder}" for folder in folders]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def commit_path(staging: str, table: str, day: date, batch: str) -> str:
    return f"{staging}/{table}/_commits/ingest_day={day.isoformat()}/{batch}"


def published_batches(
    spark: SparkSession, staging: str, table: str, after: datetime | None = None
) -> list[tuple[str, str]]:
    """(day folder, batch) of what was published on the days that may hold rows after ``after``."""
    first = f"ingest_day={after.date().isoformat()}" if after else ""
    commits = f"{staging}/{table}/_commits"
    days = [day for day in marker_names(spark, commits) if day >= first]
    return [(day, name) for day in days for name in marker_names(spark, f"{commits}/{day}")]


def read_batches(spark: SparkSession, staging: str, table: str, folders: list[str]) -> DataFrame:
    """All columns of some batches' folders."""
    return read_folders(spark, f"{staging}/{table}", STAGING_LAYOUT[table], folders)


def _staged_since(
    spark: SparkSession, staging: str, table: str, statuses: tuple[str, ...], after: datetime | None
) -> DataFrame | None:
    """Scan of the batches that may hold rows ingested later, None if there are none."""
    folders = []
    published: dict[str, set[str]] = {}
    for day, batch in published_batches(spark, staging, table, after):
        published.setdefault(day, set()).add(f"{BATCH}={batch}")
    for status in statuses:
        for day, batches in published.items():
            # A batch without rows of this status has no folder.
            of_day = f"row_status={status}/{day}"
            present = folder_names(spark, f"{staging}/{table}/{of_day}")
            folders += [f"{of_day}/{batch}" for batch in present if batch in batches]
    if not folders:
        return None
    rows = read_batches(spark, staging, table, folders)
    if after is not None:
        rows = newer_than(rows.where(F.col("ingest_day") >= F.lit(after.date())), after)
    return rows


def read_delivered(
    spark: SparkSession, staging: str, table: str, after: datetime | None = None
) -> DataFrame:
    """All rows as they lie in staging, fitting and misfit."""
    rows = _staged_since(spark, staging, table, (ROW_OK, ROW_CORRUPT), after)
    return empty_table(spark, STAGING_LAYOUT[table]) if rows is None else rows


def read_staging(
    spark: SparkSession,
    staging: str,
    table: str,
    after: datetime | None = None,
    row_ids: bool = False,
) -> DataFrame:
    """Staged rows, all columns; ``after`` keeps the rows ingested strictly later.

    With ``row_ids``, a table with files also gives each row's identity.
    """
    rows = _staged_since(spark, staging, table, (ROW_OK,), after)
    if rows is None:
        return empty_table(spark, STAGING[table])
    columns = [F.col(c) for c in STAGING[table].fieldNames()]
    if row_ids:
        columns.append(file_row_id().alias(ROW_ID))
    return rows.select(*columns)


def read_corrupt_rows(
    spark: SparkSession, staging: str, table: str, after: datetime | None = None
) -> DataFrame:
    """Delivered lines that did not fit their feed's types."""
    columns = [CORRUPT_TEXT, "ingest_date", SOURCE_FILE]
    rows = _staged_since(spark, staging, table, (ROW_CORRUPT,), after)
    if rows is None:
        return empty_table(spark, STAGING_LAYOUT[table]).select(*columns)
    return rows.select(*columns)


def read_file_accounts(
    spark: SparkSession, staging: str, table: str, after: datetime | None = None
) -> DataFrame:
    """What became of each delivered file, and how many rows it had; published batches only."""
    folders = [f"{day}/{BATCH}={b}" for day, b in published_batches(spark, staging, table, after)]
    return read_folders(spark, f"{staging}/{table}_files", FILE_ACCOUNTS, folders)


def newer_than(rows: DataFrame, watermark: datetime) -> DataFrame:
    """Incremental filter, strict; a plain comparison, so it reaches the Parquet scan."""
    return rows.where(F.col("ingest_date") > F.lit(watermark.isoformat(" ")).cast("timestamp_ntz"))


def _published(spark: SparkSession, warehouse: str, table: str, snapshot: Snapshot | None) -> DataFrame:
    snapshot = snapshot or read_snapshot(spark, warehouse)
    rows = read_table(spark, f"{warehouse}/{table}", WAREHOUSE_LAYOUT[table])
    return rows.where(snapshot.counts()).drop(LOAD)


def read_warehouse(
    spark: SparkSession, warehouse: str, table: str, snapshot: Snapshot | None = None
) -> DataFrame:
    """A table's published rows; as of a snapshot, or now."""
    return _published(spark, warehouse, table, snapshot).select(*WAREHOUSE[table].fieldNames())


def read_load(spark: SparkSession, warehouse: str, table: str, load: int) -> DataFrame:
    """The rows of one load, published or not."""
    rows = read_table(spark, f"{warehouse}/{table}", WAREHOUSE_LAYOUT[table])
    return rows.where(F.col(LOAD) == load).select(*WAREHOUSE[table].fieldNames())


def read_fact(spark: SparkSession, warehouse: str) -> DataFrame:
    """The fact with its partition column, for readers that prune by month."""
    return _published(spark, warehouse, "fact_sales", None)


def read_dimension_keys(
    spark: SparkSession, warehouse: str, table: str, snapshot: Snapshot | None = None
) -> DataFrame:
    """Key column only."""
    return read_warehouse(spark, warehouse, table, snapshot).select(DIMENSION_KEYS[table])


def read_fact_grain(
    spark: SparkSession, warehouse: str, days: list[int], snapshot: Snapshot | None = None
) -> DataFrame:
    """Grain columns of the given days: their months' folders, and in these their days."""
    path = f"{warehouse}/fact_sales"
    snapshot = snapshot or read_snapshot(spark, warehouse)
    months = [f"{FACT_PARTITION}={month}" for month in sorted({day // 100 for day in days})]
    present = sorted(set(months).intersection(folder_names(spark, path)))
    rows = read_folders(spark, path, WAREHOUSE_LAYOUT["fact_sales"], present).where(snapshot.counts())
    if len(days) <= LISTED_DAYS:
        rows = rows.where(F.col("date_id").isin(days))
    return rows.select(*FACT_GRAIN)
