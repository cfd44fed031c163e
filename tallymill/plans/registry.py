"""Every operator as a query over the test tables: ``name -> f(spark, sf_dir)``.

Results use plain types (decimals as doubles, dates as text), so that any client compares alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tallymill.operators.cleaning import (
    clean_product_prices,
    clean_sales_numbers,
    enforce_column_types,
    enforce_sales_types,
    impute_transaction_dates,
    normalize_blank_strings,
)
from tallymill.operators.duplicates import ROW_ID
from tallymill.operators.incremental import new_dimension_rows, new_fact_rows
from tallymill.operators.shaping import (
    build_dim_date,
    to_dimension,
    to_fact,
    transform_customers,
    transform_products,
    transform_sales,
)
from tallymill.operators.splits import (
    RAW_DATE,
    detect_corrupt_sales,
    detect_multi_customer_transactions,
    detect_orphan_sales,
    validate_transaction_dates,
)
from tallymill.plans import analytics, checks
from tallymill.plans.batch import (
    SALES_CLEAN,
    Batch,
    Cleaned,
    append_staging,
    clean_batch,
    clean_customers,
    clean_products,
    prepare_sales,
    read_ledger,
    run,
)
from tallymill.plans.star import Star
from tallymill.schemas import AUDIT, FEEDS, WAREHOUSE
from tallymill.session import apply_settings, in_parallel, new_work_path, settle
from tallymill.sinks.audit import PIPELINE_NAME, SUCCESS, upsert
from tallymill.sinks.quarantine import STAGE_OF_FEED, quality_counts, write_rejects
from tallymill.sinks.staging import STAGED, publish_batch
from tallymill.sources.csv_files import read_rejected_csv
from tallymill.sources.tables import (
    CORRUPT_TEXT,
    SOURCE_FILE,
    newer_than,
    read_file_accounts,
    read_staging,
    read_warehouse,
)
from tallymill.sources.testviews import in_two_days, star, view
from tallymill.streaming.file_ingest import drop_csv, ingest

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 1, 1)
FIRST_DAY = datetime(2024, 1, 1)
RUN_ID = "20240101_000000"
KEY_OF_FEED = {
    "customers_stage": "customer_id",
    "products_stage": "product_id",
    "sales_transactions_stage": "transaction_id",
}


def plain_types(df: DataFrame) -> DataFrame:
    def plain(field):
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


# --- inputs ---


def _staged(spark, d, name) -> DataFrame:
    return view(spark, d, name)


def _rows(spark, d, name) -> DataFrame:
    """Staged rows as a user sees them, without row identity."""
    return _staged(spark, d, name).drop(ROW_ID)


def _customers(spark, d):
    return clean_customers(_staged(spark, d, "customers_stage"))


def _products(spark, d):
    return clean_products(_staged(spark, d, "products_stage"))


def _written_sales(spark, d):
    """Staged sales as a written table, as staging is: for steps that read them more than once."""
    return settle(_staged(spark, d, "sales_transactions_stage"), "sales-staged")


def _prepared_sales(spark, d):
    return prepare_sales(_written_sales(spark, d))


def _cleaned(spark, d) -> Cleaned:
    """All three feeds cleaned, the sales classified and written once."""
    customers, products = (_staged(spark, d, t) for t in ("customers_stage", "products_stage"))
    return clean_batch(Batch(customers, products, _written_sales(spark, d)))


def _clean_sales(spark, d):
    return _cleaned(spark, d).sales.where(F.col("outcome") == SALES_CLEAN)


def _facts(spark, d):
    return to_fact(transform_sales(enforce_sales_types(_clean_sales(spark, d))))


def _dirty_star(spark, d) -> Star:
    return Star(
        view(spark, d, "dim_customer"),
        view(spark, d, "dim_product"),
        view(spark, d, "gapped_dim_date"),
        view(spark, d, "dirty_fact"),
    )


def _staged_star(spark, d) -> Star:
    """Staging in the place of the dimensions, to give the key checks something to find."""
    return Star(
        _rows(spark, d, "customers_stage"),
        _rows(spark, d, "products_stage"),
        view(spark, d, "dim_date"),
        view(spark, d, "fact_sales"),
    )


# --- queries that need more than one call ---


def _rejected_union(spark, d) -> DataFrame:
    """Rejects exported as CSV per batch, then read back with one glob."""
    numbered = (
        _cleaned(spark, d)
        .rejects["sales_transactions_stage"]
        .select(
            "batch_idx",
            *FEEDS["sales_transactions_stage"].fieldNames(),
            RAW_DATE,
            "reject_reason",
        )
    )
    folder = new_work_path(spark, "rejects")
    write_rejects(numbered, folder, RUN_ID, F.lower("reject_reason"), "csv")
    back = read_rejected_csv(spark, f"{folder}/*/*/*/*.csv", numbered.schema)
    return back.withColumn(
        "is_nat_text", F.coalesce(F.col(RAW_DATE) == "NaT", F.lit(False))
    )


def _incremental_extract(spark, d) -> DataFrame:
    sales = in_two_days(_rows(spark, d, "sales_transactions_stage"), "sales_transactions_stage")
    return newer_than(sales, FIRST_DAY)


def _new_dimension_rows(spark, d) -> DataFrame:
    customers, _ = _customers(spark, d)
    shaped = to_dimension(transform_customers(customers, AS_OF), "dim_customer")
    first = in_two_days(_rows(spark, d, "customers_stage"), "customers_stage")
    loaded = first.where(F.col("ingest_date") <= F.lit(FIRST_DAY).cast("timestamp_ntz"))
    return new_dimension_rows(shaped, loaded.select("customer_id").distinct(), "customer_id")


def _new_fact_rows(spark, d) -> DataFrame:
    sales = in_two_days(_clean_sales(spark, d), "sales_transactions_stage")
    facts = transform_sales(enforce_sales_types(sales))
    first = F.col("ingest_date") <= F.lit(FIRST_DAY).cast("timestamp_ntz")
    return new_fact_rows(to_fact(facts.where(~first)), to_fact(facts.where(first)))


def _audit_upsert(spark, d) -> DataFrame:
    """Audit rows of the first day per feed, then the sales feed's row of the second day."""

    def entry(rows: DataFrame, name: str, bad) -> DataFrame:
        return rows.agg(
            F.max("ingest_date").alias("last_processed_ingest_date"),
            F.count("*").alias("records_processed"),
            F.count_if(bad).alias("records_rejected"),
            F.count_if(~bad).alias("records_loaded"),
        ).select(
            F.lit(name).alias("pipeline_name"),
            "*",
            F.lit(SUCCESS).alias("run_status"),
            F.lit("2024-01-03 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        )

    first, second = {}, {}
    for table in KEY_OF_FEED:
        staged = in_two_days(_rows(spark, d, table), table)
        second[table] = newer_than(staged, FIRST_DAY)
        first[table] = staged.where(F.col("ingest_date") <= F.lit(FIRST_DAY).cast("timestamp_ntz"))
    no_date = F.col("transaction_date").isNull()
    existing = reduce(
        DataFrame.unionByName,
        [
            entry(first["customers_stage"], "customers", F.col("email").isNull()),
            entry(first["products_stage"], "products", F.col("product_name").isNull()),
            entry(first["sales_transactions_stage"], PIPELINE_NAME, no_date),
        ],
    )
    changes = entry(second["sales_transactions_stage"], PIPELINE_NAME, no_date)
    return upsert(existing, changes, "pipeline_name").select(*AUDIT.fieldNames())


def _dq_report(spark, d) -> DataFrame:
    none = F.lit(None).cast("string")
    cleaned = _cleaned(spark, d)
    stage = F.coalesce(F.lower("reject_reason"), F.lit("load"))
    parts = [quality_counts(cleaned.sales, RUN_ID, "sales_transactions_stage", stage)]
    for table, clean in (
        ("customers_stage", cleaned.customers),
        ("products_stage", cleaned.products),
    ):
        loaded, bad = clean.withColumn("reject_reason", none), cleaned.rejects[table]
        parts.append(quality_counts(loaded, RUN_ID, table, F.lit("load")))
        parts.append(quality_counts(bad, RUN_ID, table, F.lit(STAGE_OF_FEED[table])))
    return reduce(DataFrame.unionByName, parts)


def _orphan_sales(spark, d) -> DataFrame:
    (customers, _), (products, _), prepared = in_parallel(
        spark,
        lambda: _customers(spark, d),
        lambda: _products(spark, d),
        lambda: _prepared_sales(spark, d),
    )
    # Written, as the checks of keys read the sales before the join does.
    sound = settle(detect_corrupt_sales(prepared)[0], "sales-sound")
    return detect_orphan_sales(sound, customers, products)[1]


def _schema_report(spark, d) -> DataFrame:
    """Could staging be loaded as it is? Against the warehouse schemas."""
    return checks.schema_report(
        {
            "dim_customer": (_rows(spark, d, "customers_stage"), WAREHOUSE["dim_customer"]),
            "dim_product": (_rows(spark, d, "products_stage"), WAREHOUSE["dim_product"]),
            "fact_sales": (_rows(spark, d, "sales_transactions_stage"), WAREHOUSE["fact_sales"]),
        }
    )


@dataclass(frozen=True)
class Delivery:
    """Folders of a delivery that was ingested, archived, and ingested again without news."""

    drop: str
    staging: str
    archive: str


def _delivered(spark, d) -> Delivery:
    """Staging as CSV files, dropped in two goes, ingested after each and once more.

    Beside a file of no feed, the second go holds customers with their columns in reverse, products
    without brands, and a copy of its sales with a column that is none of the feed's.
    """
    root = new_work_path(spark, "stream")
    drop, staging, archive = f"{root}/drop", f"{root}/staging", f"{root}/archive"
    # Written: the rows of a go are dropped more than once.
    staged = {t: settle(in_two_days(_rows(spark, d, t), t), f"{t}-staged") for t in KEY_OF_FEED}
    later = F.col("ingest_date") > F.lit(FIRST_DAY).cast("timestamp_ntz")
    first = {table: rows.where(~later).drop("ingest_date") for table, rows in staged.items()}
    second = {table: rows.where(later).drop("ingest_date") for table, rows in staged.items()}
    odd = {
        "customers_stage": second["customers_stage"].select(*reversed(FEEDS["customers_stage"].fieldNames())),
        "products_stage": second["products_stage"].drop("brand"),
    }
    sales = second["sales_transactions_stage"]
    for number, part in enumerate((first, second | odd), start=1):
        for table, rows in part.items():
            drop_csv(rows, drop, f"{table.upper()}_{number}")
        drop_csv(part["sales_transactions_stage"], drop, f"Unknown_{number}")
        if number == 2:
            drop_csv(sales.withColumn("channel", F.lit("web")), drop, "transactions_with_channel")
        ingest(spark, drop, staging, f"{root}/checkpoints", archive)
    ingest(spark, drop, staging, f"{root}/checkpoints", archive)
    return Delivery(drop, staging, archive)


def _streamed_staging(spark, d) -> DataFrame:
    """All rows that a delivery staged, with the number of their go."""
    staging = _delivered(spark, d).staging
    none = F.lit(None)
    shown = {
        "customers_stage": ("customer_id", "customer_name", "city", none.cast("double")),
        "products_stage": ("product_id", "product_name", "brand", F.col("unit_price")),
        "sales_transactions_stage": ("transaction_id", "transaction_date", none.cast("string"), F.col("unit_price")),
    }

    def rows(table: str) -> DataFrame:
        key, text, other, amount = shown[table]
        found = read_staging(spark, staging, table)
        # A go is the rank of its stamp among the table's two.
        first = F.lit(found.agg(F.min("ingest_date").cast("string")).first()[0]).cast("timestamp_ntz")
        return found.select(
            F.lit(table).alias("table_name"),
            F.col(key).alias("row_key"),
            F.col(text).alias("text"),
            (F.col(other) if isinstance(other, str) else other).alias("other"),
            amount.alias("amount"),
            F.when(F.col("ingest_date") == first, 1).otherwise(2).alias("go"),
        )

    return reduce(DataFrame.unionByName, [rows(table) for table in shown])


def _archived_files(spark, d) -> DataFrame:
    """Per feed: rows delivered in staged files, rows of them that misfit, whether the staged files
    are those in the archive, and whether files are left in the folder (those set aside)."""
    went = _delivered(spark, d)

    def names(folder: str, marker: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.lit(True).alias(marker))

    def account(table: str) -> DataFrame:
        told = read_file_accounts(spark, went.staging, table)
        archived = names(f"{went.archive}/{table}", "archived")
        placed = told.join(archived, "file_name", "full").join(names(went.drop, "left"), "file_name", "left")
        staged = F.col("verdict") == STAGED
        return placed.agg(
            F.sum(F.when(staged, F.col("delivered"))).alias("delivered"),
            F.sum(F.when(staged, F.col("misfit"))).alias("misfit"),
            F.bool_and(F.coalesce(staged, F.lit(False)) == F.col("archived").isNotNull()).alias("staged_are_archived"),
            F.bool_or(F.col("left").isNotNull()).alias("files_left"),
        ).select(F.lit(table).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [account(table) for table in KEY_OF_FEED])


def _table_sums(spark, warehouse) -> DataFrame:
    """Rows, distinct keys and a sum of each warehouse table."""
    sums = {
        "dim_customer": (F.sum("customer_id"), "customer_id"),
        "dim_product": (F.sum("product_id"), "product_id"),
        "dim_date": (F.sum("date_id"), "date_id"),
        "fact_sales": (F.sum("net_sale_amount"), "sales_id"),
    }
    parts = [
        read_warehouse(spark, warehouse, table)
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct(key).alias("distinct_keys"),
            total.cast("double").alias("total"),
        )
        .select(F.lit(table).alias("table_name"), "*")
        for table, (total, key) in sums.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _loaded_warehouse(spark, d) -> DataFrame:
    """The fact after two runs over the same staging, of which the second finds nothing new; and how
    many ids there are between the lowest and the highest one."""
    root = new_work_path(spark, "load")
    staging, warehouse = f"{root}/staging", f"{root}/warehouse"
    for table in KEY_OF_FEED:
        append_staging(_rows(spark, d, table), staging, table)
    run(spark, staging, warehouse, "first", AS_OF)
    run(spark, staging, warehouse, "second", AS_OF)
    fact = read_warehouse(spark, warehouse, "fact_sales")
    span = fact.agg(
        F.when(F.count_distinct("sales_id") == F.count("*"), F.max("sales_id") - F.min("sales_id") + 1)
    ).first()[0]
    return fact.drop("sales_id").withColumn("id_span", F.lit(span).cast("long"))


def _run_accounting(spark, d) -> DataFrame:
    """What became of all delivered rows, per load and feed. Both loads have the same run id: the
    first takes the dimensions, the second the sales. Rows whose key ends in 77 are misfits."""
    root = new_work_path(spark, "accounts")
    staging, warehouse = f"{root}/staging", f"{root}/warehouse"

    def stage(table: str) -> None:
        key = F.col(KEY_OF_FEED[table])
        append_staging(_rows(spark, d, table), staging, table)
        # Taken from the staged rows, so that the feed is worked out once.
        bad = read_staging(spark, staging, table).where(key % 100 == 77).withColumns(
            {CORRUPT_TEXT: key.cast("string"), SOURCE_FILE: F.lit("bad.csv")}
        )
        publish_batch(staging, table, "misfits", FIRST_DAY.date(), bad)

    for tables in (("customers_stage", "products_stage"), ("sales_transactions_stage",)):
        for table in tables:
            stage(table)
        run(spark, staging, warehouse, RUN_ID, AS_OF)
    return read_ledger(spark, warehouse)


def _constraint_gate(spark, d) -> DataFrame:
    """Staged rows as they are, offered to a star that holds the keys of the first day."""
    new = Star(
        _rows(spark, d, "customers_stage").withColumn("customer_id", F.expr("nullif(customer_id, 5)")),
        _rows(spark, d, "products_stage"),
        view(spark, d, "gapped_dim_date"),
        view(spark, d, "dirty_fact"),
    )

    def first_day(table: str) -> DataFrame:
        staged = in_two_days(_rows(spark, d, table), table)
        return staged.where(F.col("ingest_date") <= F.lit(FIRST_DAY).cast("timestamp_ntz"))

    calendar = view(spark, d, "dim_date").where("day <= 2")
    loaded = Star(first_day("customers_stage"), first_day("products_stage"), calendar, view(spark, d, "fact_sales"))
    return checks.constraint_violations(new, loaded)


def _late_feed_load(spark, d) -> DataFrame:
    """Sales that are staged after a run, but stamped before its customers and products."""
    root = new_work_path(spark, "late")
    staging, warehouse = f"{root}/staging", f"{root}/warehouse"
    later = F.expr("ingest_date + INTERVAL 10 DAYS")
    for table in ("customers_stage", "products_stage"):
        append_staging(_rows(spark, d, table).withColumn("ingest_date", later), staging, table)
    run(spark, staging, warehouse, "first", AS_OF)
    append_staging(_rows(spark, d, "sales_transactions_stage"), staging, "sales_transactions_stage")
    run(spark, staging, warehouse, "second", AS_OF)
    run(spark, staging, warehouse, "third", AS_OF)
    return _table_sums(spark, warehouse)


def _typed_staging(spark, d) -> DataFrame:
    customers = normalize_blank_strings(_rows(spark, d, "customers_stage"))
    typed = enforce_column_types(
        customers, {"customer_id": "int", "signup_date": "datetime"}, "customers_stage"
    )
    return typed.select("customer_id", "customer_name", "signup_date")


def _date_issue_sample(spark, d) -> DataFrame:
    bad, _ = checks.split_by_date_issue(_rows(spark, d, "sales_transactions_stage"))
    columns = ["transaction_id", "transaction_date", "date_issue_reason"]
    # Ordered, so that the sample is the same each time.
    return checks.sample_rows(bad.select(*columns).orderBy(*[F.asc_nulls_last(c) for c in columns]))


def _imputed(spark, d) -> DataFrame:
    return impute_transaction_dates(
        normalize_blank_strings(_rows(spark, d, "sales_transactions_stage")),
        normalize_blank_strings(_rows(spark, d, "customers_stage")),
        as_of=AS_OF,
    )


def _on_star(report) -> Query:
    return lambda spark, d: report(star(spark, d))


def _on_dirty_star(check) -> Query:
    return lambda spark, d: check(_dirty_star(spark, d))


def _on_view(name: str, operator) -> Query:
    return lambda spark, d: operator(_rows(spark, d, name))


QUERIES: dict[str, Query] = {
    # reports
    "top_products_by_revenue": _on_star(analytics.top_products_by_revenue),
    "monthly_revenue": _on_star(analytics.monthly_revenue),
    "avg_order_value": _on_star(analytics.avg_order_value),
    "top_customers_by_ltv": _on_star(analytics.top_customers_by_ltv),
    "category_revenue_share": _on_star(analytics.category_revenue_share),
    "customer_retention": _on_star(analytics.customer_retention),
    "customer_retention_fixed": _on_star(analytics.customer_retention_fixed),
    "rolling_3_month_avg": _on_star(analytics.rolling_3_month_avg),
    "best_product_per_month": _on_star(analytics.best_product_per_month),
    "declining_customers": _on_star(analytics.declining_customers),
    "revenue_by_day_type": _on_star(analytics.revenue_by_day_type),
    # warehouse checks
    "orphan_fact_customers": _on_dirty_star(checks.orphan_fact_customers),
    "orphan_fact_products": _on_dirty_star(checks.orphan_fact_products),
    "orphan_fact_dates": _on_dirty_star(checks.orphan_fact_dates),
    "duplicate_fact_grain": _on_view("fact_sales", checks.duplicate_fact_grain),
    "line_total_mismatch": _on_view("dirty_fact", checks.line_total_mismatch),
    "total_reconciliation": _on_view("dirty_fact", checks.total_reconciliation),
    "discount_sanity": _on_view("dirty_fact", checks.discount_sanity),
    "not_null_violations": lambda s, d: checks.not_null_violations(_staged_star(s, d)),
    "unique_violations": lambda s, d: checks.unique_violations(_staged_star(s, d)),
    # staging checks
    "duplicate_customers": _on_view("customers_stage", checks.duplicate_customers),
    "duplicate_products": _on_view("products_stage", checks.duplicate_products),
    "sales_by_transaction": _on_view("sales_transactions_stage", checks.sales_by_transaction),
    "duplicate_transactions": _on_view("sales_transactions_stage", checks.duplicate_transactions),
    "malformed_dates": _on_view("sales_transactions_stage", checks.malformed_dates),
    "rejected_union": _rejected_union,
    "date_issue_profile": _on_view("sales_transactions_stage", checks.date_issue_profile),
    "date_issue_sample": _date_issue_sample,
    "date_format_profile": _on_view("sales_transactions_stage", checks.date_format_profile),
    "schema_report": _schema_report,
    # cleaning
    "normalized_customers": _on_view("customers_stage", normalize_blank_strings),
    "normalized_products": _on_view("products_stage", normalize_blank_strings),
    "normalized_sales": _on_view("sales_transactions_stage", normalize_blank_strings),
    "clean_sales_numbers": _on_view("sales_transactions_stage", clean_sales_numbers),
    "clean_product_prices": _on_view("products_stage", clean_product_prices),
    "typed_staging": _typed_staging,
    "imputed_transaction_dates": _imputed,
    # splits
    "customers_dedup_clean": lambda s, d: _customers(s, d)[0],
    "customers_dedup_rejected": lambda s, d: _customers(s, d)[1],
    "products_dedup_clean": lambda s, d: _products(s, d)[0],
    "products_dedup_rejected": lambda s, d: _products(s, d)[1],
    "valid_date_sales": _on_view(
        "sales_transactions_stage", lambda df: validate_transaction_dates(df)[0]
    ),
    "invalid_date_sales": _on_view(
        "sales_transactions_stage", lambda df: validate_transaction_dates(df)[1]
    ),
    "corrupt_sales": lambda s, d: detect_corrupt_sales(
        _prepared_sales(s, d).where(F.col("transaction_date").isNotNull())
    )[1],
    "multi_customer_transactions": _on_view(
        "sales_transactions_stage", lambda df: detect_multi_customer_transactions(df)[1]
    ),
    "orphan_sales": _orphan_sales,
    # warehouse tables and loading
    "dim_customer": lambda s, d: to_dimension(
        transform_customers(_customers(s, d)[0], AS_OF), "dim_customer"
    ),
    "dim_product": lambda s, d: to_dimension(
        transform_products(_products(s, d)[0]), "dim_product"
    ),
    "dim_date": lambda s, d: build_dim_date(_clean_sales(s, d)),
    "fact_sales": _facts,
    "new_dimension_rows": _new_dimension_rows,
    "new_fact_rows": _new_fact_rows,
    "incremental_extract": _incremental_extract,
    "audit_upsert": _audit_upsert,
    "dq_report": _dq_report,
    "streamed_staging": _streamed_staging,
    "archived_files": _archived_files,
    "loaded_warehouse": _loaded_warehouse,
    "late_feed_load": _late_feed_load,
    "run_accounting": _run_accounting,
    "constraint_gate": _constraint_gate,
}


def _ready(query: Query) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_types(query(apply_settings(spark), sf_dir))

    return call


def queries() -> dict[str, Query]:
    return {name: _ready(query) for name, query in QUERIES.items()}
