"""Staging and star views over the test tables, with faults placed by key arithmetic.

One text per view serves Spark and the SQL checks, so both read the same rows. ``{table}`` names a
test table, ``<..>`` what the dialects spell differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators.duplicates import file_row_id
from tallymill.plans.star import Star

_CUSTOMER_COLUMNS = """
  CASE WHEN c_custkey % 10 = 0 THEN concat('  ', c_name) ELSE upper(c_name) END AS customer_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '   '
       ELSE concat('User', CAST(c_custkey AS <TEXT>), '@Example.com') END AS email,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE n_name END AS city,
  CASE WHEN c_custkey % 10 = 3 THEN '' ELSE lower(r_name) END AS state,
  CASE WHEN c_custkey % 20 = 7 THEN 'invalid_date'
       ELSE CAST(DATE '2019-01-01' + CAST(({shift}) % 1800 AS INT) AS <TEXT>) END AS signup_date,
  CAST('2024-01-01 00:00:00' AS <NTZ>) AS ingest_date"""

_CUSTOMER_SOURCE = """
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey"""

_PRODUCT_COLUMNS = """
  CASE WHEN p_partkey % 7 = 0 THEN 'Oil' WHEN p_partkey % 17 = 0 THEN '12345'
       WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN ' Up '
       ELSE concat(upper(p_name), ' ') END AS product_name,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_type END AS category,
  CASE WHEN p_partkey % 9 = 0 THEN '  ' ELSE p_brand END AS brand,
  CASE WHEN p_partkey % 10 = 1 THEN NULL WHEN p_partkey % 10 = 2 THEN -10.0e0
       WHEN p_partkey % 10 = 3 THEN 0.0e0 ELSE p_retailprice END AS unit_price,
  CAST('2024-01-01 00:00:00' AS <NTZ>) AS ingest_date"""

_SALES_SOURCE = """
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey"""

_DATE_ID = (
    "CAST(year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate) AS INT)"
)
_LINE = "CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(10,2))"

VIEWS = {
    "customers_stage": (
        "SELECT c_custkey AS customer_id,"
        + _CUSTOMER_COLUMNS.replace("{shift}", "c_custkey")
        + "<ID0>"
        + _CUSTOMER_SOURCE
        + "\nUNION ALL\nSELECT c_custkey % 37 AS customer_id,"
        + _CUSTOMER_COLUMNS.replace("{shift}", "c_custkey * 7")
        + "<ID1>"
        + _CUSTOMER_SOURCE
        + "\nWHERE c_custkey % 25 = 17"
    ),
    "products_stage": (
        "SELECT p_partkey AS product_id,"
        + _PRODUCT_COLUMNS
        + "<ID0>"
        + "\nFROM {part}\nUNION ALL\nSELECT p_partkey % 37 AS product_id,"
        + _PRODUCT_COLUMNS
        + "<ID1>"
        + "\nFROM {part}\nWHERE p_partkey % 40 = 5"
    ),
    "sales_transactions_stage": """
SELECT
  CASE WHEN l_orderkey % 33 = 0 THEN CAST(l_linenumber AS BIGINT)
       ELSE l_orderkey * 10 + l_linenumber END AS transaction_id,
  CASE WHEN l_orderkey % 12 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS customer_id,
  CASE WHEN l_orderkey % 14 = 0 THEN l_partkey + 1000000 ELSE l_partkey END AS product_id,
  CASE WHEN l_orderkey % 20 = 3 THEN '2023-99-99' WHEN l_orderkey % 20 = 4 THEN NULL
       WHEN l_orderkey % 40 = 5 THEN '  ' WHEN l_orderkey % 40 = 6 THEN concat(CAST(CAST(o_orderdate AS DATE) AS <TEXT>), ' 23:45:00')
       WHEN l_orderkey % 40 = 7 THEN concat(CAST(CAST(o_orderdate AS DATE) AS <TEXT>), 'T00:00:01')
       WHEN l_orderkey % 40 = 25 THEN concat(CAST(CAST(o_orderdate AS DATE) AS <TEXT>), ' 25:00:00')
       WHEN l_orderkey % 40 = 27 THEN replace(CAST(CAST(o_orderdate AS DATE) AS <TEXT>), '-', '')
       ELSE CAST(CAST(o_orderdate AS DATE) AS <TEXT>) END AS transaction_date,
  CASE WHEN l_orderkey % 997 = 5 THEN 3.0e9 WHEN (l_orderkey + l_linenumber) % 30 = 0 THEN NULL
       WHEN (l_orderkey + l_linenumber) % 30 = 1 THEN -3.0e0
       WHEN (l_orderkey + l_linenumber) % 30 = 2 THEN 0.0e0 ELSE l_quantity END AS quantity,
  CASE WHEN l_partkey % 499 = 498 THEN 1.0e17 WHEN l_partkey % 30 = 0 THEN NULL WHEN l_partkey % 30 = 1 THEN -20.0e0
       WHEN l_partkey % 30 = 2 THEN 0.0e0 ELSE p_retailprice END AS unit_price,
  CASE WHEN l_orderkey % 5 = 0 THEN l_discount * 100 ELSE 0.0e0 END AS discount,
  CAST('2024-01-01 00:00:00' AS <NTZ>) AS ingest_date"""
    + _SALES_SOURCE,
    "dim_customer": "SELECT c_custkey AS customer_id, c_name AS customer_name FROM {customer}",
    "dim_product": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
  p_retailprice AS unit_price FROM {part}""",
    "dim_date": f"""
SELECT DISTINCT {_DATE_ID} AS date_id, CAST(o_orderdate AS DATE) AS date,
  CAST(day(o_orderdate) AS INT) AS day, CAST(month(o_orderdate) AS INT) AS month,
  CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(year(o_orderdate) AS INT) AS year,
  <WEEKDAY> AS weekday FROM {{orders}}""",
    "fact_sales": f"""
SELECT o_custkey AS customer_id, l_partkey AS product_id, {_DATE_ID} AS date_id,
  CAST(l_quantity AS INT) AS quantity, p_retailprice AS unit_price,
  CAST({_LINE} AS DECIMAL(18,2)) AS total_sale_amount,
  CAST({_LINE} - CAST(l_discount * 100 AS DECIMAL(10,2)) AS DECIMAL(18,2)) AS net_sale_amount"""
    + _SALES_SOURCE,
    # A fact with faults for the warehouse checks: unknown keys, signs, discounts above the total
    # and totals that are a cent off.
    "dirty_fact": f"""
SELECT CASE WHEN l_orderkey % 12 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS customer_id,
  CASE WHEN l_orderkey % 14 = 0 THEN l_partkey + 1000000 ELSE l_partkey END AS product_id,
  {_DATE_ID} AS date_id, CAST(l_quantity AS INT) AS quantity, p_retailprice AS unit_price,
  CAST({_LINE} + CASE WHEN l_partkey % 50 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(18,2))
    AS total_sale_amount,
  CAST(CASE WHEN (l_orderkey + l_linenumber) % 30 = 1 THEN -1 ELSE 1 END * {_LINE}
    - CASE WHEN l_orderkey % 35 = 0 THEN CAST(-5 AS DECIMAL(10,2))
           ELSE CAST(l_discount * 100 AS DECIMAL(10,2)) END AS DECIMAL(18,2)) AS net_sale_amount"""
    + _SALES_SOURCE,
    # A calendar that lacks the 29th of every month.
    "gapped_dim_date": f"""
SELECT DISTINCT {_DATE_ID} AS date_id, CAST(day(o_orderdate) AS INT) AS day
FROM {{orders}} WHERE day(o_orderdate) <> 29""",
}

# Columns the views use, stated so that no job has to read footers for them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double,"
    " l_discount double",
}
_WITH_ROW_ID = {"customers_stage": "customer", "products_stage": "part"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    for spelled, here in {
        "<TEXT>": "STRING",
        "<NTZ>": "TIMESTAMP_NTZ",
        "<WEEKDAY>": "date_format(o_orderdate, 'EEEE')",
        "<ID0>": ", struct(0 AS branch, source_row) AS row_id",
        "<ID1>": ", struct(1 AS branch, source_row) AS row_id",
    }.items():
        text = text.replace(spelled, here)
    frames = {}
    for table, columns in TABLES.items():
        if f"{{{table}}}" in text:
            frames[table] = spark.read.schema(columns).parquet(f"{sf_dir}/{table}.parquet")
            if _WITH_ROW_ID.get(name) == table:
                frames[table] = frames[table].select("*", file_row_id().alias("source_row"))
    return spark.sql(text, **frames)


def sql_view(name: str) -> str:
    """The same view for the SQL check."""
    text = VIEWS[name]
    for spelled, here in {
        "<TEXT>": "VARCHAR",
        "<NTZ>": "TIMESTAMP",
        "<WEEKDAY>": "dayname(o_orderdate)",
        "<ID0>": "",
        "<ID1>": "",
        "{": "",
        "}": "",
    }.items():
        text = text.replace(spelled, here)
    return text


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(
        *[view(spark, sf_dir, t) for t in ("dim_customer", "dim_product", "dim_date", "fact_sales")]
    )


# The increments: rows whose key ends in a digit below this arrive on the first day, the others on
# the second. Transaction ids end in the line number, 1 to 7.
FIRST_DAY_DIGITS = {
    "customers_stage": ("customer_id", 8),
    "products_stage": ("product_id", 8),
    "sales_transactions_stage": ("transaction_id", 6),
}


def in_two_days(staged: DataFrame, table: str) -> DataFrame:
    key, digits = FIRST_DAY_DIGITS[table]
    day = F.when(F.col(key) % 10 < digits, "2024-01-01").otherwise("2024-01-02")
    return staged.withColumn("ingest_date", day.cast("timestamp_ntz"))
