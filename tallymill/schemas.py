"""Column names and types of every table, one ``StructType`` per regime."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# CSV feeds, typed as staging keeps them; dates stay text until they are parsed.
FEEDS: dict[str, StructType] = {
    "customers_stage": _struct(
        customer_id=LongType(),
        customer_name=StringType(),
        email=StringType(),
        city=StringType(),
        state=StringType(),
        signup_date=StringType(),
    ),
    "products_stage": _struct(
        product_id=LongType(),
        product_name=StringType(),
        category=StringType(),
        brand=StringType(),
        unit_price=DoubleType(),
    ),
    "sales_transactions_stage": _struct(
        transaction_id=LongType(),
        customer_id=LongType(),
        product_id=LongType(),
        transaction_date=StringType(),
        quantity=DoubleType(),
        unit_price=DoubleType(),
        discount=DoubleType(),
    ),
}

STAGING: dict[str, StructType] = {
    name: StructType([*feed.fields, StructField("ingest_date", TimestampNTZType(), True)])
    for name, feed in FEEDS.items()
}

WAREHOUSE: dict[str, StructType] = {
    "dim_customer": _struct(
        customer_id=LongType(),
        customer_name=StringType(),
        email=StringType(),
        city=StringType(),
        state=StringType(),
        signup_date=DateType(),
    ),
    "dim_product": _struct(
        product_id=LongType(),
        product_name=StringType(),
        category=StringType(),
        brand=StringType(),
        unit_price=DoubleType(),
    ),
    "dim_date": _struct(
        date_id=IntegerType(),
        date=DateType(),
        day=IntegerType(),
        month=IntegerType(),
        quarter=IntegerType(),
        year=IntegerType(),
        weekday=StringType(),
    ),
    "fact_sales": _struct(
        sales_id=LongType(),
        customer_id=LongType(),
        product_id=LongType(),
        date_id=IntegerType(),
        quantity=IntegerType(),
        unit_price=DoubleType(),
        total_sale_amount=MONEY,
        net_sale_amount=MONEY,
    ),
}

FACT_COLUMNS = [f.name for f in WAREHOUSE["fact_sales"].fields if f.name != "sales_id"]
FACT_GRAIN = ["customer_id", "product_id", "date_id"]

DIMENSION_KEYS = {
    "dim_customer": "customer_id",
    "dim_product": "product_id",
    "dim_date": "date_id",
}

AUDIT = _struct(
    pipeline_name=StringType(),
    last_processed_ingest_date=TimestampNTZType(),
    records_processed=LongType(),
    records_rejected=LongType(),
    records_loaded=LongType(),
    run_status=StringType(),
    updated_at=TimestampNTZType(),
)

QUALITY_REPORT = _struct(
    run_id=StringType(),
    table_name=StringType(),
    stage=StringType(),
    reason=StringType(),
    row_count=LongType(),
)

LEDGER = _struct(
    run_id=StringType(),
    load=IntegerType(),
    table_name=StringType(),
    delivered=LongType(),
    misfit=LongType(),
    rejected=LongType(),
    loaded=LongType(),
)

CONSTRAINTS = _struct(table_name=StringType(), constraint_name=StringType(), violations=LongType())
