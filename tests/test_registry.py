"""How the queries feed their operators."""

import pytest
from pyspark.sql import functions as F

from tallymill.plans import registry
from tallymill.session import apply_settings, settle
from tests.conftest import SMALL


class Stop(Exception):
    pass


def reads_lines(df):
    return "lineitem.parquet" in df._jdf.queryExecution().optimizedPlan().toString() or any(
        "lineitem" in file for file in df.inputFiles()
    )


def test_sales_that_are_read_often_are_written_first(spark, monkeypatch):
    seen = []

    def stop(batch):
        seen.append(batch.sales)
        raise Stop

    monkeypatch.setattr(registry, "clean_batch", stop)
    for query in ("dim_date", "fact_sales", "new_fact_rows", "dq_report", "rejected_union"):
        with pytest.raises(Stop):
            registry.queries()[query](spark, SMALL)
    assert len(seen) == 5 and not any(reads_lines(sales) for sales in seen)
    assert not reads_lines(registry.queries()["orphan_sales"](spark, SMALL))


def test_delivered_rows_are_worked_out_once(spark, monkeypatch):
    dropped = []
    monkeypatch.setattr(registry, "drop_csv", lambda df, folder, name: dropped.append(df))
    monkeypatch.setattr(registry, "ingest", lambda *args: None)
    registry._delivered(apply_settings(spark), SMALL)
    assert len(dropped) == 9 and not any(reads_lines(df) for df in dropped)


@pytest.mark.parametrize("parts", [3, 40])
def test_partition_folders_are_written_without_a_sort(spark, parts):
    """Up to 16 side by side; rows of more are all there as well."""
    assert int(apply_settings(spark).conf.get("spark.sql.maxConcurrentOutputFileWriters")) == 16
    rows = spark.range(0, 1000, 1, 2).withColumn("part", F.col("id") % parts)
    assert settle(rows, "parted", partition_by="part").exceptAll(rows).count() == 0
    assert settle(rows, "parted", partition_by="part").count() == 1000


def test_misfits_are_taken_from_staged_rows(spark, monkeypatch):
    misfits = []
    monkeypatch.setattr(registry, "publish_batch", lambda staging, table, batch, day, rows: misfits.append(rows))
    monkeypatch.setattr(registry, "run", lambda *args: None)
    monkeypatch.setattr(registry, "read_ledger", lambda *args: spark.range(0))
    registry.queries()["run_accounting"](spark, SMALL)
    assert len(misfits) == 3 and not any(reads_lines(df) for df in misfits)
    rows = registry._rows(spark, SMALL, "sales_transactions_stage").where("transaction_id % 100 = 77")
    assert misfits[2].select(*rows.columns).exceptAll(rows).count() == 0 and misfits[2].count() == rows.count()
