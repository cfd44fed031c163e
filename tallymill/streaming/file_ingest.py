"""Watching a folder for CSV files and appending them to staging.

One stream per feed, so a feed that fails does not stop the others. A stream carries the names of
new files only; each micro-batch looks at its files' headers on the executors, reads files of the
same header together by column name, and publishes the batch by one marker. A file that cannot be
staged is set aside with its reason and the others go on. Names, verdicts and row counts of all
files are kept beside the staged rows. The checkpoint and the batch's name together stage a file
exactly once, whatever is restarted. Rows that do not fit their feed go to the same table's
``row_status=corrupt`` folder.
"""

from __future__ import annotations

import logging
import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymill.schemas import FEEDS
from tallymill.sinks.staging import STAGED, no_rows, publish_batch
from tallymill.sources.csv_files import (
    CSV_WRITE_OPTIONS,
    DeliveredFile,
    feed_glob,
    inspect_files,
    read_with_header,
    staging_table_of,
    unknown_files,
)
from tallymill.sources.markers import create_once, move_file, read_marker

logger = logging.getLogger(__name__)


LOGGED_NAMES = 20
# A backlog of any size is staged in steps of this many files.
FILES_PER_BATCH = 10_000
# Files of this many different headers are read by one plan.
HEADERS_PER_PLAN = 40
FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"


@dataclass
class IngestReport:
    """``unknown_files``: all names that belong to no feed. ``failed``: error by feed."""

    unknown_files: DataFrame
    failed: dict[str, str]


def stream_name(spark: SparkSession, checkpoints: str, table: str) -> str:
    """A name that the stream of this checkpoint keeps over restarts, and no other stream has."""
    path = f"{checkpoints}/{table}.name"
    create_once(spark, path, uuid.uuid4().hex)
    return read_marker(spark, path)


def batch_stamp(spark: SparkSession, staging: str, table: str, batch: str) -> datetime:
    """The time (UTC) a batch was first begun; a replay keeps it, so it publishes the same day."""
    path = f"{staging}/{table}/_begun/{batch}"
    create_once(spark, path, datetime.now(timezone.utc).replace(tzinfo=None).isoformat())
    return datetime.fromisoformat(read_marker(spark, path))


def stage_files(
    spark: SparkSession, paths: list[str], staging: str, table: str, batch: str
) -> list[DeliveredFile]:
    """Stage the files of one micro-batch under the batch's name; returns what became of each."""
    delivered = inspect_files(spark, paths, table)
    stamp = batch_stamp(spark, staging, table, batch)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in delivered:
        if not file.trouble:
            by_header.setdefault(file.columns, []).append(file.path)
    headers = sorted(by_header)
    steps = [headers[k : k + HEADERS_PER_PLAN] for k in range(0, len(headers), HEADERS_PER_PLAN)]
    aside = [f for f in delivered if f.trouble]
    for number, step in enumerate(steps or [[]]):
        frames = [read_with_header(spark, by_header[h], h, table) for h in step]
        rows = reduce(DataFrame.unionByName, frames, no_rows(spark, table).drop("ingest_date"))
        told = [f for f in delivered if f.columns in step] + (aside if number == 0 else [])
        verdicts = spark.createDataFrame(
            [(f.name, f.trouble or STAGED, f.detail) for f in told],
            "file_name string, verdict string, detail string",
        )
        stamped = rows.withColumn("ingest_date", F.lit(stamp.isoformat(" ")).cast("timestamp_ntz"))
        publish_batch(staging, table, f"{batch}.{number}", stamp.date(), stamped, verdicts)
    return delivered


def stage_once(
    spark: SparkSession,
    paths: list[str],
    staging: str,
    table: str,
    batch: str,
    archive: str | None = None,
) -> None:
    """Stage a micro-batch unless that was done before, then move its staged files away.

    The files that were staged are named in the marker, so a replay after a crash between
    staging and moving still moves them.
    """
    done = f"{staging}/{table}/_batches/{batch}"
    if read_marker(spark, done) is None:
        delivered = stage_files(spark, paths, staging, table, batch)
        for file in [f for f in delivered if f.trouble][:LOGGED_NAMES]:
            logger.error("%s is set aside: %s %s", file.name, file.trouble, file.detail or "")
        create_once(spark, done, "\n".join(f.path for f in delivered if not f.trouble))
    if archive:
        for path in filter(None, read_marker(spark, done).split("\n")):
            move_file(spark, path, f"{archive}/{table}/{path.rsplit('/', 1)[-1]}")


def start_feed(
    spark: SparkSession,
    folder: str,
    staging: str,
    checkpoints: str,
    table: str,
    archive: str | None = None,
    max_files_per_batch: int = FILES_PER_BATCH,
    poll_seconds: int | None = None,
) -> StreamingQuery:
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("pathGlobFilter", feed_glob(table))
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(folder)
        # No content is read. The pattern also lets in names that carry two feeds' words; the
        # first word decides.
        .select("path")
        .where(staging_table_of(F.element_at(F.split("path", "/"), -1)) == table)
    )
    own_name = stream_name(spark, checkpoints, table)

    def stage(batch: DataFrame, batch_id: int) -> None:
        # Some names with pattern characters make the stream list other files twice.
        paths = sorted({row["path"] for row in batch.collect()})
        if paths:
            name = f"{own_name}-{batch_id:010d}"
            stage_once(batch.sparkSession, paths, staging, table, name, archive)

    writer = (
        files.writeStream.foreachBatch(stage)
        .queryName(f"stage-{table}-{time.time_ns()}")
        .option("checkpointLocation", f"{checkpoints}/{table}")
    )
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def ingest(
    spark: SparkSession,
    folder: str,
    staging: str,
    checkpoints: str,
    archive: str | None = None,
    max_files_per_batch: int = FILES_PER_BATCH,
    seconds: int | None = None,
    poll_seconds: int = 5,
) -> IngestReport:
    """Stage what lies in ``folder``; with ``seconds``, keep watching for that long.

    A feed that fails is logged and reported, the others go on. A file that cannot be staged stays
    where it is, with its reason in the table's file accounts. Files of no known feed stay
    where they are, are reported, and the first of them are logged. Staged files move to
    ``archive`` as soon as their batch is published.
    """
    errors: dict[str, str] = {}

    def failed(table: str, error: Exception) -> None:
        logger.error("ingestion of %s failed: %s", table, error)
        errors[table] = str(error)

    running: dict[str, StreamingQuery] = {}
    for table in FEEDS:
        try:
            running[table] = start_feed(
                spark,
                folder,
                staging,
                checkpoints,
                table,
                archive,
                max_files_per_batch,
                None if seconds is None else poll_seconds,
            )
        except Exception as error:  # one feed's trouble is no reason to stop the others
            failed(table, error)

    if seconds is not None:
        deadline = time.monotonic() + seconds
        while time.monotonic() < deadline and any(q.isActive for q in running.values()):
            time.sleep(min(1, poll_seconds))
        for query in running.values():
            query.stop()
    for table, query in running.items():
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failed(table, error)
    report = IngestReport(unknown_files(spark, folder), errors)
    for row in report.unknown_files.take(LOGGED_NAMES):
        logger.warning("unknown file type, skipped: %s", row["file_name"])
    return report


def drop_csv(df: DataFrame, folder: str, name: str) -> None:
    """Put ``df`` into a watched folder as CSV files called ``name-<n>.csv``.

    Executors write the files beside the folder; each then appears there whole, by a rename.
    """
    spark = df.sparkSession
    beside = f"{folder}-writing/{name}"
    df.write.mode("errorifexists").options(**CSV_WRITE_OPTIONS).csv(beside)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(beside), hadoop.Path(folder)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    parts = files.globStatus(hadoop.Path(f"{beside}/part-*.csv"))
    for index, part in enumerate(parts):
        files.rename(part.getPath(), hadoop.Path(f"{folder}/{name}-{index}.csv"))
