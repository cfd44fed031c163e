from datetime import datetime

from pyspark.sql import functions as F

from tallymill.operators import incremental
from tallymill.operators.incremental import new_dimension_rows, new_fact_rows
from tallymill.sinks.audit import read_audit, record_run, last_watermark, FIRST_WATERMARK
from tallymill.sources.tables import newer_than
from tests.conftest import values


def test_new_dimension_rows(frame):
    batch = frame("k int, v string", (1, "a"), (2, "b"), (3, "c"))
    assert values(new_dimension_rows(batch, frame("k int", (2,), (9,)), "k")) == [(1, "a"), (3, "c")]


FACT = "customer_id long, product_id long, date_id int, quantity int"


def test_new_fact_rows_keeps_repeats_of_the_batch(frame):
    batch = frame(FACT, (1, 1, 20240101, 5), (1, 1, 20240101, 6), (2, 1, 20240101, 7))
    loaded = frame(FACT, (2, 1, 20240101, 1), (2, 1, 20240101, 2), (1, 1, 20240102, 1))
    assert values(new_fact_rows(batch, loaded)) == [(1, 1, 20240101, 5), (1, 1, 20240101, 6)]


def test_month_of_a_date_key(frame):
    df = frame("d int", (20240131,), (99991231,), (None,))
    assert values(df.select(incremental.date_month("d"))) == [(202401,), (999912,), (None,)]


def test_ids_follow_each_other_over_files(spark, folder):
    spark.range(0, 1000, 1, 7).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    for _ in range(2):
        firsts = incremental.first_ids(incremental.file_sizes(rows), 1 << 40)
        out = incremental.with_ids(rows, firsts, "own_id")
        found = {r["id"]: r["own_id"] for r in out.collect()}
        assert sorted(found.values()) == list(range(1 << 40, (1 << 40) + 1000))
    again = {r["id"]: r["own_id"] for r in out.repartition(3).collect()}
    assert again == found


def test_ids_have_room_for_many_large_tasks(spark):
    sizes = spark.range(1 << 18).select(
        F.format_string("part-%08d", "id").alias("file"), F.lit(1 << 40).alias("n")
    )
    firsts = incremental.first_ids(sizes, 1).agg(F.min("first_id"), F.max("first_id"), F.count_distinct("first_id")).first()
    assert tuple(firsts) == (1, ((1 << 18) - 1) * (1 << 40) + 1, 1 << 18)


def test_watermark_filter_is_strict(frame):
    df = frame("ingest_date timestamp_ntz", (datetime(2024, 1, 1),), (datetime(2024, 1, 1, 0, 0, 0, 1),))
    assert values(newer_than(df, datetime(2024, 1, 1))) == [(datetime(2024, 1, 1, 0, 0, 0, 1),)]


def test_audit_keeps_one_row_per_pipeline(spark, folder):
    path = f"{folder}/audit"
    assert last_watermark(spark, path) == FIRST_WATERMARK
    record_run(spark, path, datetime(2024, 1, 1, 12), 10, 2, 8)
    record_run(spark, path, datetime(2024, 1, 3), 1, 1, 0, pipeline_name="other")
    record_run(spark, path, datetime(2024, 1, 2, 1, 2, 3, 4), 20, 5, 15)
    audit = read_audit(spark, path)
    assert values(audit, "pipeline_name", "records_processed", "records_loaded") == [
        ("other", 1, 0), ("sales_etl", 20, 15)
    ]
    assert audit.where(F.col("updated_at").isNull()).count() == 0
    assert last_watermark(spark, path) == datetime(2024, 1, 2, 1, 2, 3, 4)
