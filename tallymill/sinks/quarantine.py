"""Rejected rows and the data-quality report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.schemas import QUALITY_REPORT
from tallymill.session import write_own_folders
from tallymill.sinks.publication import LOAD
from tallymill.sources.csv_files import CSV_WRITE_OPTIONS

LOADED = "LOADED"
MISFIT = "MISFIT_ROW"
STAGE_OF_FEED = {
    "customers_stage": "customer_duplicates",
    "products_stage": "product_duplicates",
}


def write_rejects(
    rejected: DataFrame,
    folder: str,
    run_id: str,
    stage: Column | str,
    file_format: str = "parquet",
    load: int = 0,
) -> None:
    """Write rejects, one folder per stage, run and load. No rows, no files.

    A run id may come again; the load number, which does not, tells its attempts apart.

    ``file_format="csv"`` writes header CSVs for hand inspection and reprocessing.
    """
    tagged = rejected.withColumns(
        {"reject_stage": F.lit(stage) if isinstance(stage, str) else stage, "run_id": F.lit(run_id)}
    ).withColumn(LOAD, F.lit(load))
    # Writers fill files to the advisory size, also where one stage has most of the rows.
    tagged = tagged.hint("rebalance", F.col("reject_stage"))
    options = CSV_WRITE_OPTIONS if file_format == "csv" else {}
    write_own_folders(
        tagged, folder, "reject_stage", "run_id", LOAD, file_format=file_format, **options
    )


def quality_counts(
    classified: DataFrame, run_id: str, table_name: str, stage: Column
) -> DataFrame:
    """Rows per outcome: ``reject_reason`` or LOADED."""
    return (
        classified.groupBy(
            stage.alias("stage"), F.coalesce("reject_reason", F.lit(LOADED)).alias("reason")
        )
        .agg(F.count("*").alias("row_count"))
        .withColumns({"run_id": F.lit(run_id), "table_name": F.lit(table_name)})
        .select(*QUALITY_REPORT.fieldNames())
    )
