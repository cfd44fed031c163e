import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallymill.plans.batch import append_staging
from tallymill.session import in_parallel
from tallymill.sinks import staging as staging_sink
from tallymill.sources import markers
from tallymill.sources.csv_files import read_feed_csv, staging_table_of
from tallymill.sources.markers import create_once, marker_names, read_marker
from tallymill.sources.tables import read_corrupt_rows, read_file_accounts, read_staging
from tallymill.streaming import file_ingest
from tallymill.streaming.file_ingest import drop_csv, ingest
from tests.conftest import values


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write(text)


CUSTOMER_HEADER = "customer_id,customer_name,email,city,state,signup_date\n"
SALES_HEADER = "transaction_id,customer_id,product_id,transaction_date,quantity,unit_price,discount\n"
PRODUCT_HEADER = "product_id,product_name,category,brand,unit_price\n"


@pytest.fixture
def places(folder):
    return f"{folder}/drop", f"{folder}/staging", f"{folder}/checkpoints"


def test_file_names_route_to_tables(frame):
    names = ["Customers.csv", "my_TRANSACTIONS_1.csv", "product.csv", "customer_product.csv",
             "product_transactions.csv", "other.csv"]
    df = frame("i int, n string", *enumerate(names))
    assert [r[0] for r in df.orderBy("i").select(staging_table_of(F.col("n"))).collect()] == [
        "customers_stage", "sales_transactions_stage", "products_stage", "customers_stage",
        "sales_transactions_stage", None,
    ]


def test_ingest(spark, places):
    drop, staging, checkpoints = places
    put(drop, "Customers_1.CSV.csv", CUSTOMER_HEADER + '1,"Doe, ""J""",,Rome,  ,2024-01-01\n2,NULL,a@b,N/A,ny,\n')
    put(drop, "customer_products.csv", CUSTOMER_HEADER + "3,Three,c@d,Oslo,ny,2024-01-02\n")
    put(drop, "PRODUCTS.csv", PRODUCT_HEADER + "10,Lamp,Home,,9.5\n11.0,Desk,Home,Acme,NaN\n")
    put(
        drop,
        "sales_transactions.csv",
        SALES_HEADER + "1,1,10,2024-01-01,2,9.5,0\n2,1,10,2023-99-99,,NA,\nx,1,10,2024-01-01,2,9.5,0\n3,1\n4.5,1,10,2024-01-01,2,9.5,0\n",
    )
    put(drop, "Unknown.csv", "a,b\n1,2\n")
    put(drop, "notes_customer.txt", "not a csv\n")
    put(f"{drop}/nested", "customers.csv", CUSTOMER_HEADER + "99,N,,,,\n")

    report = ingest(spark, drop, staging, checkpoints)
    assert values(report.unknown_files) == [("Unknown.csv",)]
    assert report.failed == {}
    columns = ("customer_id", "customer_name", "email", "city", "state", "signup_date")
    assert values(read_staging(spark, staging, "customers_stage"), *columns) == [
        (1, 'Doe, "J"', None, "Rome", "  ", "2024-01-01"),
        (2, None, "a@b", None, "ny", None),
        (3, "Three", "c@d", "Oslo", "ny", "2024-01-02"),
    ]
    assert values(read_staging(spark, staging, "products_stage"), "product_id", "brand", "unit_price") == [
        (10, None, 9.5), (11, "Acme", None)
    ]
    sales = read_staging(spark, staging, "sales_transactions_stage")
    assert values(sales, "transaction_id", "transaction_date", "quantity", "unit_price") == [
        (1, "2024-01-01", 2.0, 9.5), (2, "2023-99-99", None, None)
    ]
    bad = values(read_corrupt_rows(spark, staging, "sales_transactions_stage"), "corrupt_text")
    assert [b[0].split(",")[0] for b in bad] == ["3", "4.5", "x"]

    stamps = sales.select("ingest_date").distinct().collect()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert len(stamps) == 1 and abs(now - stamps[0][0]) < timedelta(minutes=5)


def test_files_are_staged_once_and_archived(spark, places, folder):
    drop, staging, checkpoints = places
    archive = f"{folder}/processed"
    for day in (1, 2, 3):
        put(drop, f"customers_{day}.csv", CUSTOMER_HEADER + f"{day},N,,,,\n")
        ingest(spark, drop, staging, checkpoints, archive=archive)
    ingest(spark, drop, staging, checkpoints, archive=archive)
    assert values(read_staging(spark, staging, "customers_stage"), "customer_id") == [(1,), (2,), (3,)]
    # also the files of the last batch
    moved = [name for _, _, names in os.walk(archive) for name in names if name.endswith(".csv")]
    assert sorted(moved) == ["customers_1.csv", "customers_2.csv", "customers_3.csv"]
    assert os.listdir(drop) == []


def test_time_boxed_watching(spark, places):
    drop, staging, checkpoints = places
    put(drop, "customers.csv", CUSTOMER_HEADER + "1,N,,,,\n")
    begun = datetime.now()
    ingest(spark, drop, staging, checkpoints, seconds=8, poll_seconds=1)
    assert datetime.now() - begun < timedelta(seconds=60)
    assert read_staging(spark, staging, "customers_stage").count() == 1


def test_a_failing_feed_does_not_stop_the_others(spark, places):
    drop, staging, checkpoints = places
    put(drop, "customers.csv", CUSTOMER_HEADER + "1,N,,,,\n")
    put(drop, "products.csv", PRODUCT_HEADER + "1,Lamp,a,b,1\n")
    os.makedirs(staging)
    with open(f"{staging}/products_stage", "w") as blocker:  # a file where the table should be
        blocker.write("x")
    report = ingest(spark, drop, staging, checkpoints)
    assert list(report.failed) == ["products_stage"]
    assert read_staging(spark, staging, "customers_stage").count() == 1


def test_bad_files_are_set_aside_and_the_others_staged_by_column_name(spark, places, folder):
    drop, staging, checkpoints = places
    put(drop, "customers_1.csv", CUSTOMER_HEADER + "1,N,,Rome,ny,\n1b,N,,,,\n")
    put(drop, "customers_2.csv", '"state","city",customer_name,customer_id\nny,Rome,M,2\n')
    put(drop, "customers_3.csv", "\ufeffcustomer_id,email\n3,a@b\n4\n")
    put(drop, "customers_[4],x.csv", CUSTOMER_HEADER)
    put(drop, "customers_5.csv", CUSTOMER_HEADER.replace("city", "town") + "5,N,,Rome,ny,\n")
    put(drop, "customers_6.csv", CUSTOMER_HEADER.replace("city", "state") + "6,N,,Rome,ny,\n")
    put(drop, "customers_7.csv", "\n7,N,,,,\n")
    put(drop, "customers_8.csv", CUSTOMER_HEADER + "8,N,,Rome,ny,\n")
    with open(f"{drop}/.customers_8.csv.crc", "wb") as wrong:  # its checksums do not fit
        wrong.write(b"crc\0\0\0\2\0" + b"\1\2\3\4")
    with open(f"{drop}/customers_9.csv", "wb") as noise:
        noise.write(bytes(range(256)) * 20)
    report = ingest(spark, drop, staging, checkpoints, archive=f"{folder}/archive")
    assert report.failed == {}
    assert values(read_staging(spark, staging, "customers_stage"), "customer_id", "customer_name", "city", "state") == [
        (1, "N", "Rome", "ny"), (2, "M", "Rome", "ny"), (3, None, None, None)
    ]
    accounts = read_file_accounts(spark, staging, "customers_stage")
    assert values(accounts, "file_name", "verdict", "delivered", "misfit") == [
        ("customers_1.csv", "STAGED", 2, 1),
        ("customers_2.csv", "STAGED", 1, 0),
        ("customers_3.csv", "STAGED", 2, 1),
        ("customers_5.csv", "UNKNOWN_COLUMN", None, None),
        ("customers_6.csv", "REPEATED_COLUMN", None, None),
        ("customers_7.csv", "EMPTY", None, None),
        ("customers_8.csv", "UNREADABLE", None, None),
        ("customers_9.csv", "UNKNOWN_COLUMN", None, None),
        ("customers_[4],x.csv", "STAGED", 0, 0),
    ]
    left = sorted(name for name in os.listdir(drop) if name.endswith(".csv"))
    assert left == [f"customers_{k}.csv" for k in (5, 6, 7, 8, 9)]
    files = values(read_corrupt_rows(spark, staging, "customers_stage"), "source_file")
    assert files == [("customers_1.csv",), ("customers_3.csv",)]


def test_many_headers_are_read_in_steps(spark, places, monkeypatch):
    drop, staging, checkpoints = places
    monkeypatch.setattr(file_ingest, "HEADERS_PER_PLAN", 2)
    columns = CUSTOMER_HEADER.strip().split(",")
    for k in range(5):
        turned = columns[k:] + columns[:k]
        row = [str(k) if c == "customer_id" else c for c in turned]
        put(drop, f"customers_{k}.csv", ",".join(turned) + "\n" + ",".join(row) + "\n")
    ingest(spark, drop, staging, checkpoints)
    assert values(read_staging(spark, staging, "customers_stage"), "customer_id", "city") == [(k, "city") for k in range(5)]


def test_a_replayed_batch_adds_nothing(spark, places, folder, monkeypatch):
    drop, staging, _ = places
    put(drop, "customers_1.csv", CUSTOMER_HEADER + "1,N,,,,\nx,N,,,,\n")
    paths, archive = [f"{drop}/customers_1.csv"], f"{folder}/archive"

    def lost(*args, **kwargs):
        raise RuntimeError("lost before publication")

    with monkeypatch.context() as broken:
        broken.setattr(staging_sink, "create_once", lost)
        with pytest.raises(RuntimeError):
            file_ingest.stage_once(spark, paths, staging, "customers_stage", "b-0", archive)
    assert read_staging(spark, staging, "customers_stage").count() == 0
    assert read_file_accounts(spark, staging, "customers_stage").count() == 0

    with monkeypatch.context() as broken:
        broken.setattr(file_ingest, "move_file", lost)
        with pytest.raises(RuntimeError):
            file_ingest.stage_once(spark, paths, staging, "customers_stage", "b-0", archive)
    assert os.listdir(drop) == ["customers_1.csv"]
    before = values(read_staging(spark, staging, "customers_stage"))
    for _ in range(2):
        file_ingest.stage_once(spark, paths, staging, "customers_stage", "b-0", archive)
        assert values(read_staging(spark, staging, "customers_stage")) == before
        assert read_corrupt_rows(spark, staging, "customers_stage").count() == 1
        assert values(read_file_accounts(spark, staging, "customers_stage"), "delivered", "misfit") == [(2, 1)]
    assert os.listdir(drop) == [] and os.listdir(f"{archive}/customers_stage") == ["customers_1.csv"]


def test_named_appends_are_added_once(spark, folder, frame):
    rows = frame(
        "product_id long, product_name string, category string, brand string, unit_price double, ingest_date timestamp_ntz",
        (1, "a", None, None, 1.0, datetime(2024, 1, 1)), (2, "b", None, None, 1.0, datetime(2024, 1, 2)), (3, "c", None, None, 1.0, None),
    )
    for _ in range(2):
        append_staging(rows, folder, "products_stage", "monday")
    assert values(read_staging(spark, folder, "products_stage"), "product_id") == [(1,), (2,), (3,)]
    assert read_staging(spark, folder, "products_stage", datetime(2024, 1, 1)).count() == 1
    append_staging(rows, folder, "products_stage")
    assert read_staging(spark, folder, "products_stage").count() == 6


def test_a_marker_has_one_creator(spark, folder, monkeypatch):
    created = in_parallel(spark, *[lambda k=k: create_once(spark, f"{folder}/one/marker", str(k)) for k in range(12)])
    assert created.count(True) == 1
    assert read_marker(spark, f"{folder}/one/marker") == str(created.index(True))
    assert os.listdir(f"{folder}/one") == ["marker"]
    assert read_marker(spark, f"{folder}/one/none") is None and marker_names(spark, f"{folder}/none") == []


def test_a_rename_replaces_nothing(spark, folder):
    put(folder, "old", "old")
    put(folder, "new", "new")
    path = spark._jvm.org.apache.hadoop.fs.Path
    with pytest.raises(Exception, match="FileAlreadyExists"):
        markers._rename_new(spark, path(f"file://{folder}/new"), path(f"file://{folder}/old"))
    markers._rename_new(spark, path(f"file://{folder}/new"), path(f"file://{folder}/other"))
    assert open(f"{folder}/old").read() == "old" and open(f"{folder}/other").read() == "new"


def test_batch_read_goes_by_the_header(spark, folder):
    put(folder, "p.csv", "unit_price,color,product_id,product_name\n2.5,red,7,Lamp\nx,red,8,Desk\n")
    got = read_feed_csv(spark, f"{folder}/p.csv", "products_stage")
    assert values(got, "product_id", "product_name", "brand", "unit_price") == [
        (7, "Lamp", None, 2.5), (8, "Desk", None, None)
    ]
    assert [r[0] is None for r in got.orderBy("product_id").select("corrupt_text").collect()] == [True, False]


def test_batch_read_of_one_file(spark, folder):
    put(folder, "products.csv", PRODUCT_HEADER + "1,Lamp,null,b,1.5\n")
    got = read_feed_csv(spark, f"{folder}/products.csv", "products_stage")
    assert values(got, "product_id", "category", "unit_price", "corrupt_text") == [(1, None, 1.5, None)]


def test_drop_csv_round_trip(spark, frame, places):
    drop, staging, checkpoints = places
    rows = [(1, ' a, "b" ', None, "x\\y", "", "2024-01-01"), (2, "two", "e", None, None, None)]
    df = frame(
        "customer_id long, customer_name string, email string, city string, state string,"
        "signup_date string", *rows
    )
    drop_csv(df, drop, "customers")
    ingest(spark, drop, staging, checkpoints)
    got = read_staging(spark, staging, "customers_stage").drop("ingest_date")
    assert values(got) == [(1, ' a, "b" ', None, "x\\y", None, "2024-01-01"), rows[1]]


def test_appended_days_are_worked_out_once(spark, folder, frame, monkeypatch):
    written = []
    write = staging_sink.write_own_folders
    monkeypatch.setattr(staging_sink, "write_own_folders", lambda df, path, *by: (written.append(path), write(df, path, *by)))
    rows = frame(
        "product_id long, product_name string, category string, brand string, unit_price double, ingest_date timestamp_ntz",
        *[(n, f"name {n}", "c", "b", 1.0, datetime(2024, 1, 1 + n % 2) if n else None) for n in range(7)],
    )
    # An attempt that died left rows of a day that this one has, and of one that it hasn't.
    left = rows.limit(1).withColumns(
        {"corrupt_text": F.lit(None).cast("string"), "source_file": F.lit(None).cast("string"), "row_status": F.lit("ok")}
    )
    for day in ("2024-01-01", "2024-03-03"):
        dated = left.withColumns({"ingest_day": F.lit(day), "batch": F.lit("monday")})
        dated.write.mode("append").partitionBy("row_status", "ingest_day", "batch").parquet(f"{folder}/products_stage")
    append_staging(rows, folder, "products_stage", "monday")
    assert written.count(f"{folder}/products_stage") == 1
    append_staging(rows, folder, "products_stage", "monday")
    found = read_staging(spark, folder, "products_stage")
    assert found.exceptAll(rows).count() == 0 and found.count() == 7
    accounts = read_file_accounts(spark, folder, "products_stage").groupBy("ingest_day").sum("delivered").collect()
    assert sorted(r[1] for r in accounts) == [1, 3, 3]
